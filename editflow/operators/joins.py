"""Lookups of models and subscriptions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.functions.calendar import week_begin
from editflow.functions.skew import as_of, lookup_join
from editflow.schema import CATCH_ALL
from editflow.session import materialize


def model_versions(models: DataFrame) -> DataFrame:
    """One row per model: channel, model_year, model_week, its centres by cluster number.

    A model has at most k centres, so the list is short.
    """
    return models.groupBy(
        "channel", F.col("year").alias("model_year"), F.col("week").alias("model_week")
    ).agg(F.sort_array(F.collect_list(F.struct("cluster", "centre"))).alias("centres"))


def channel_centres(models: DataFrame) -> DataFrame:
    """One row per channel: the model of its newest ISO year and week."""
    version = F.struct("model_year", "model_week", "centres")
    newest = model_versions(models).groupBy("channel").agg(F.max(version).alias("_newest"))
    return newest.select("channel", "_newest.*")


def attach_model(counts: DataFrame, models: DataFrame, when: str = "newest") -> DataFrame:
    """Counts with the model of their channel; counts without a model drop out.

    when='newest' takes the model of the newest ISO year and week for all counts.
    when='before' takes the newest model whose week was over when the count's interval
    began, so that old counts are compared with what was known at their time.
    """
    if when == "newest":
        return lookup_join(counts, channel_centres(models), ["channel"], spread=["bucket"])
    versions = materialize(model_versions(models), "versions")
    ends = F.date_add(week_begin(F.col("model_year"), F.col("model_week")), 7).cast("timestamp")
    found = as_of(
        counts, versions.withColumn("_since", ends), ["channel"], "bucket", "_since", ["model_year", "model_week"]
    )
    # The sort carries the two numbers; the centres are looked up.
    return lookup_join(found, versions, ["channel", "model_year", "model_week"], spread=["bucket"])


def nearest_centroid(
    counts: DataFrame, models: DataFrame, value: str = "n", when: str = "newest"
) -> DataFrame:
    """Cluster, centre and distance nearest to each count; the lowest cluster wins a tie.

    The nearest centre is picked from the model's list in the row itself, so no
    row is multiplied by the number of centres and nothing is grouped again.
    """
    distances = F.transform(
        "centres",
        lambda c: F.struct(
            F.abs(F.col(value) - c["centre"]).alias("distance"),
            c["cluster"].alias("cluster"),
            c["centre"].alias("centre"),
        ),
    )
    return (
        attach_model(counts, models, when)
        .withColumn("_nearest", F.array_min(distances))
        .select(
            *counts.columns,
            F.col("_nearest.cluster").alias("cluster"),
            F.col("_nearest.centre").alias("centre"),
            F.col("_nearest.distance").alias("distance"),
        )
    )


def route_edits(edits: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Each edit once per subscriber of its channel or of the catch-all.

    An edit goes out under two routes, its channel and the catch-all, so that one
    equality join covers both kinds of subscription; the catch-all only if anyone wants it.
    """
    wanted = subscriptions.select("subscriber", F.lower("channel").alias("route"))
    if wanted.where(F.col("route") == CATCH_ALL).isEmpty():
        routed = edits.withColumn("route", F.col("channel"))
    else:
        routes = F.array_distinct(F.array("channel", F.lit(CATCH_ALL)))
        routed = edits.withColumn("route", F.explode(routes))
    spread = ["id"] if "id" in edits.columns else edits.columns
    return lookup_join(routed, wanted, ["route"], spread=spread).drop("route")
