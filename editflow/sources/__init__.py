"""Readers and writers of lines, bus frames, edit tables, models and metrics."""
