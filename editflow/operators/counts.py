"""Counts per interval and channel."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editflow.functions.skew import running
from editflow.operators.filters import filter_channel, filter_week
from editflow.operators.series import zero_fill
from editflow.schema import ALL_MESSAGES
from editflow.session import materialize


def _windowed(df: DataFrame, interval: str) -> DataFrame:
    return df.withColumn("_window", F.window("ts", interval))


def _bucket() -> Column:
    return F.col("_window.start").alias("bucket")


def count_all(df: DataFrame, interval: str = "10 seconds") -> DataFrame:
    counted = _windowed(df, interval).groupBy("_window").agg(F.count("*").alias("n"))
    return counted.select(_bucket(), F.lit(ALL_MESSAGES).alias("name"), "n")


def count_by_channel(df: DataFrame, interval: str = "10 seconds") -> DataFrame:
    counted = _windowed(df, interval).groupBy("_window", "channel").agg(F.count("*").alias("n"))
    return counted.select(_bucket(), "channel", "n")


def with_totals(per_channel: DataFrame) -> DataFrame:
    """Counts per channel and their sums over all channels, by counter name."""
    both = per_channel.groupingSets([["bucket"], ["bucket", "channel"]], "bucket", "channel").agg(
        F.sum("n").alias("n"), F.grouping("channel").alias("_total")
    )
    name = F.when(F.col("_total") == 1, ALL_MESSAGES).otherwise(F.col("channel"))
    return both.select("bucket", name.alias("name"), "n")


def count_rollup(df: DataFrame, interval: str = "10 seconds") -> DataFrame:
    """Both levels at once; the edits are read and counted once, the totals add up the counts."""
    return with_totals(count_by_channel(df, interval))


def count_matching(
    df: DataFrame, name: str, predicate: Column, interval: str, start: int = 0
) -> DataFrame:
    """Rows that satisfy the predicate, on top of `start`, per interval.

    Intervals run from the first row to the last; one without rows has the count `start`.
    """
    counted = _windowed(df, interval).groupBy("_window").agg(
        (F.count_if(predicate) + F.lit(start)).alias("n")
    )
    named = counted.select(_bucket(), F.lit(name).alias("name"), "n")
    return zero_fill(named, interval, ["name"], start)


def count_items(df: DataFrame) -> DataFrame:
    """Total rows; with a column `_ok` also accepted and rejected ones."""
    totals = [F.count("*").alias("items")]
    if "_ok" in df.columns:
        totals += [
            F.count_if(F.col("_ok")).alias("accepted"),
            F.count_if(~F.col("_ok")).alias("rejected"),
        ]
    return df.agg(*totals)


def inserted_total(df: DataFrame, interval: str = "10 seconds") -> DataFrame:
    """Running number of edits at the end of each interval."""
    per_interval = materialize(count_all(df, interval), "counts")
    daily = per_interval.withColumn("_day", F.date_trunc("day", "bucket"))
    totals = running(daily, [], "_day", "bucket", "n", "inserted")
    return totals.select("bucket", "n", "inserted")


# Columns of one cell of the week. Neither has more than 7 * 1440 cells per channel.
GRAINS = {
    "minute": ["weekday", "day_minute"],
    "hour": ["weekday", "hour"],
}


def week_cells(df: DataFrame, grain: str = "minute") -> DataFrame:
    """Edits per channel and cell of the week; empty cells are absent."""
    return df.groupBy("channel", *GRAINS[grain]).agg(F.count("*").alias("n"))


def weekly_minute_counts(
    df: DataFrame, channel: str, week: int, grain: str = "minute", year: int | None = None
) -> DataFrame:
    return week_cells(filter_week(filter_channel(df, channel), week, year), grain).drop("channel")


def count_vectors(df: DataFrame, as_vector: bool = False) -> DataFrame:
    """The counts alone, as a one-dimensional feature."""
    feature = F.col("n").cast("double")
    if as_vector:
        from pyspark.ml.functions import array_to_vector

        return df.select(array_to_vector(F.array(feature)).alias("features"))
    return df.select(feature.alias("feature"))


def anomaly_counts(scored: DataFrame, interval: str = "60 seconds") -> DataFrame:
    """Number of anomalous counts per channel and interval."""
    marked = scored.withColumn("_window", F.window("bucket", interval))
    counted = marked.groupBy("_window", "channel").agg(
        F.count_if(F.col("is_anomaly")).alias("n")
    )
    name = F.concat(F.col("channel"), F.lit("-anomaly")).alias("name")
    return counted.select(_bucket(), name, "n")
