"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.llm.tables import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches, itself included.

    Large-star and small-star steps in turn, until the links form stars: each step is a
    minimum per node, combined before the shuffle, and one join. Links with a null end
    and loops are ignored; nodes without links don't appear.
    """
    edges = stored(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    while not _is_star_forest(edges):
        edges = stored(_small_star(_large_star(edges)), "links")
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether each node has one link down and no node has links both ways."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"))
    )
    roles = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return roles.where("ups > 1 or (ups = 1 and least = 0)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = (
        edges.join(least, "u")
        .where("v > m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return below.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
