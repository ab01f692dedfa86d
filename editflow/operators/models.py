"""Models of normal activity, and the anomaly rule.

A model is a set of one-dimensional centres per channel and ISO week: the counts per minute
of the week in at most k clusters.
"""

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.functions.calendar import iso_year
from editflow.functions.clusters import best_clusters
from editflow.operators.counts import GRAINS
from editflow.operators.filters import filter_channel, filter_week
from editflow.operators.joins import nearest_centroid
from editflow.schema import MODEL
from editflow.session import materialize, scratch_path, scratch_scope

# Clusters per model, convergence tolerance, anomaly tolerance.
CLUSTERS = 55
TOLERANCE = 1e-6
EPSILON = 0.05


def _histogram(df: DataFrame, week: int, grain: str, year: int | None) -> DataFrame:
    """channel, n, cells: how many cells of the week hold n edits, in the newest year that has the week."""
    cells = filter_week(df, week, year).groupBy("channel", iso_year().alias("iso_year"), *GRAINS[grain])
    counted = cells.agg(F.count("*").alias("n")).groupBy("channel", "iso_year", "n")
    counted = materialize(counted.agg(F.count("*").alias("cells")), "histogram")
    newest = counted.select(F.max("iso_year")).scalar() if year is None else F.lit(year)
    return counted.where(F.col("iso_year") == newest)


def _best_rows(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        channel, year, cells = [], [], []
        for name, iso, points in zip(*(batch.column(i).to_pylist() for i in range(3))):
            values = np.array([p["n"] for p in points], np.int64)
            centres = best_clusters(values, np.array([p["cells"] for p in points], np.int64), k)
            cells += list(enumerate(centres))
            channel += [name] * len(centres)
            year += [iso] * len(centres)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(channel, pa.string()),
                pa.array(year, pa.int32()),
                pa.array([i for i, _ in cells], pa.int32()),
                pa.array([c for _, c in cells], pa.float64()),
            ],
            ["channel", "year", "cluster", "centre"],
        )


def _best(histogram: DataFrame, k: int) -> DataFrame:
    """Best clusters of every channel at once. A channel's distinct counts are one row.

    A cell of the week is one count, so the list has at most 7 * 1440 entries.
    """
    lists = histogram.groupBy("channel", F.col("iso_year").cast("int").alias("year")).agg(
        F.sort_array(F.collect_list(F.struct("n", "cells"))).alias("points")
    )
    return lists.mapInArrow(partial(_best_rows, k=k), "channel string, year int, cluster int, centre double")


def fit_channel_model(
    df: DataFrame,
    channel: str,
    week: int,
    k: int = CLUSTERS,
    grain: str = "minute",
    year: int | None = None,
) -> DataFrame:
    """Model of one channel and ISO week of an edit table with calendar columns."""
    return fit_all_models(filter_channel(df, channel), week, k, grain, year)


def fit_all_models(
    df: DataFrame,
    week: int,
    k: int = CLUSTERS,
    grain: str = "minute",
    year: int | None = None,
) -> DataFrame:
    """Models of all channels of an ISO week at once: the k clusters with the least squared distance.

    Without an ISO year, the newest one counts in which the week has edits. The edits are
    reduced to (channel, count, number of cells) in one pass. Within a channel the best
    clusters are found exactly, see `best_clusters`; channels go to different tasks.
    """
    found = _best(_histogram(df, week, grain, year), k)
    return found.select("channel", "year", F.lit(week).cast("int").alias("week"), "cluster", "centre")


def fit_models_stepwise(
    df: DataFrame,
    week: int,
    k: int = CLUSTERS,
    iterations: int = 20,
    tol: float = TOLERANCE,
    grain: str = "minute",
    year: int | None = None,
) -> DataFrame:
    """The same by Lloyd's iterations, which may end in clusters that are not the best ones.

    The start is deterministic: evenly spaced ranks among a channel's distinct counts. A
    cluster without members keeps its centre. Stops when no centre moves by more than `tol`.
    """
    spark = df.sparkSession
    histogram = _histogram(df, week, grain, year)
    values = F.sort_array(F.collect_set("n"))
    ranks = F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda j: F.floor(j * (F.size("_values") - 1) / F.lit(max(k - 1, 1))).cast("int"),
    )
    spaced = F.transform(ranks, lambda r: F.get("_values", r).cast("double"))
    centres = materialize(
        histogram.groupBy("channel", F.col("iso_year").cast("int").alias("year"))
        .agg(values.alias("_values"))
        .select("channel", "year", F.array_distinct(spaced).alias("centres")),
        "centres",
    )
    final = scratch_path(spark, "centres")
    with scratch_scope(spark):  # the steps' tables go when the last one is stored
        for _ in range(iterations):
            stepped = materialize(_step(histogram, centres), "step")
            centres = stepped.drop("_shift")
            if (stepped.agg(F.max("_shift")).first()[0] or 0.0) <= tol:
                break
        centres.write.parquet(final)
    return spark.read.schema(centres.schema).parquet(final).select(
        "channel",
        "year",
        F.lit(week).cast("int").alias("week"),
        F.posexplode("centres").alias("cluster", "centre"),
    )


def _step(histogram: DataFrame, centres: DataFrame) -> DataFrame:
    """centres moved to the means of their clusters, and by how much at most."""
    nearest = F.array_min(
        F.transform("centres", lambda c, i: F.struct(F.abs(F.col("n") - c), i.alias("cluster")))
    )
    means = (
        histogram.join(centres, "channel")
        .groupBy("channel", nearest["cluster"].alias("cluster"))
        .agg((F.sum(F.col("n") * F.col("cells")) / F.sum("cells")).alias("mean"))
        .groupBy("channel")
        .agg(F.map_from_entries(F.collect_list(F.struct("cluster", "mean"))).alias("_means"))
    )
    moved = F.transform("centres", lambda c, i: F.coalesce(F.try_element_at("_means", i), c))
    shifts = F.zip_with("centres", "_moved", lambda old, new: F.abs(new - old))
    stepped = centres.join(means, "channel").withColumn("_moved", moved)
    return stepped.select(
        "channel", "year", F.col("_moved").alias("centres"), F.array_max(shifts).alias("_shift")
    )


def score_distance(df: DataFrame, value: str = "n") -> DataFrame:
    """Distance of each value to its centre."""
    return df.withColumn("distance", F.abs(F.col(value) - F.col("centre")))


def clustering_score(
    df: DataFrame, models: DataFrame | None = None, k: int | None = None
) -> DataFrame:
    """Mean distance of the counts to their nearest centre, per channel.

    Without models, the counts are taken as one series and the best k centres are fitted.
    """
    if models is None:
        df = df.select(F.lit("all").alias("channel"), F.lit(0).alias("bucket"), "n")
        points = df.groupBy("channel", "n").agg(F.count("*").alias("cells"))
        models = _best(points.withColumn("iso_year", F.lit(0)), k)
        models = models.withColumn("week", F.lit(0)).select(*MODEL.fieldNames())
    elif "bucket" not in df.columns:
        df = df.withColumn("bucket", F.xxhash64(*df.columns))
    scored = nearest_centroid(df, models)
    return scored.groupBy("channel").agg(F.avg("distance").alias("score"))


def detect_anomalies(
    counts: DataFrame, models: DataFrame, eps: float = EPSILON, when: str = "newest"
) -> DataFrame:
    """Anomaly iff the distance is greater than the centre's share `eps`.

    `when` chooses among several models of a channel, see `attach_model`. Fill empty
    intervals before scoring: a count of 0 is an anomaly wherever its nearest centre is positive.
    """
    scored = nearest_centroid(counts, models, when=when)
    return scored.withColumn("is_anomaly", F.col("centre") * F.lit(eps) < F.col("distance"))
