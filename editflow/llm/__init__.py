"""Operators that prepare training text: near copies, archives, mixing, scoring, cleaning.

Nothing else in the package imports this one.
"""
