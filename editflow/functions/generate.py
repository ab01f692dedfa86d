"""Expressions that must run once per row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly columns through a generator.

    A filter on a plain column moves below the projection and takes a copy of its
    expression along; it cannot move below a generator.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))
