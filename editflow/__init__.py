"""Wiki edit streams and tables on PySpark."""

__version__ = "0.1.0"
