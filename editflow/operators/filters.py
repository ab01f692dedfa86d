"""Filters and samples."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.functions.calendar import iso_year
from editflow.functions.skew import numbered
from editflow.schema import CATCH_ALL


def filter_channel(df: DataFrame, channel: str) -> DataFrame:
    """Edits of one channel; the catch-all keeps all. The edit's channel keeps its case."""
    wanted = channel.lower()
    return df if wanted == CATCH_ALL else df.where(F.col("channel") == wanted)


def filter_week(df: DataFrame, week: int, year: int | None = None) -> DataFrame:
    """Edits of an ISO week number, of every ISO year or of one; a year needs year, month and week."""
    chosen = df.where(F.col("week") == week)
    return chosen if year is None else chosen.where(iso_year() == year)


def sample_metrics(
    df: DataFrame, rate: float, seed: int = 0, keys: Sequence[str] = ("event_id",)
) -> DataFrame:
    """Keep a share `rate` of the rows, and note the rate on the row.

    A row is chosen by the first 32 bits of the MD5 of its keys and the seed, so it is the same one in every
    run, also after a lost executor, and whatever the partitions are.
    """
    text = F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    drawn = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    kept = df if rate >= 1 else df.where(drawn < F.lit(rate * 2**32))
    return kept.withColumn("rate", F.lit(float(rate)))


def every_nth(df: DataFrame, n: int, order: Sequence[str] = ("ts", "id")) -> DataFrame:
    """Rows 0, n, 2n, ... in `order`, with their position."""
    positions = numbered(df, order, "position").withColumn("position", F.col("position") - 1)
    return positions.where(F.col("position") % n == 0)


def recent_window(df: DataFrame, length: str = "15 minutes", now=None) -> DataFrame:
    """Rows not older than `length` before `now`, or before the newest row."""
    newest = df.select(F.max("ts")).scalar() if now is None else F.lit(now).cast("timestamp")
    return df.where(F.col("ts") >= newest - F.expr(f"interval {length}"))
