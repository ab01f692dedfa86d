"""Count series: filling, smoothing, numbering."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editflow.functions.intervals import interval_micros
from editflow.functions.skew import numbered
from editflow.schema import STORED_KEY
from editflow.session import materialize

# Slots that one row expands to when a series is filled.
FILL_BLOCK = 10_000


def zero_fill(
    counts: DataFrame, interval: str, keys: Sequence[str] = ("channel",), empty: int = 0
) -> DataFrame:
    """A row for each interval of each series, from its first one to the last of all.

    `keys` name a series: the channel, or the `name` of counters. `empty` is the count of
    an interval without a row.

    The counts are used three times and written out once for that. A series is cut
    into blocks that are spread before they are expanded, so a long series is not
    built by one task.
    """
    step, keys = interval_micros(interval), list(keys)
    slotted = materialize(counts.select("bucket", *keys, "n"), "counts").withColumn(
        "_slot", F.expr(f"(unix_micros(bucket) - pmod(unix_micros(bucket), {step})) div {step}")
    )
    last = slotted.select(F.max("_slot")).scalar()
    first_slots = slotted.groupBy(*keys).agg(F.min("_slot").alias("_first"))
    blocks = first_slots.withColumn("_last", last).withColumn(
        "_block", F.explode(F.expr(f"sequence(cast(floor(_first / {FILL_BLOCK}) as bigint), cast(floor(_last / {FILL_BLOCK}) as bigint))"))
    )
    # With a number given, the few rows of the blocks are not merged into one task again.
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = blocks.repartition(tasks, *keys, "_block").select(
        *keys,
        F.explode(
            F.sequence(
                F.greatest(F.col("_first"), F.col("_block") * FILL_BLOCK),
                F.least(F.col("_last"), F.col("_block") * FILL_BLOCK + FILL_BLOCK - 1),
            )
        ).alias("_slot"),
    )
    known = slotted.select(*keys, "_slot", "n")
    return slots.join(known, keys + ["_slot"], "left").select(
        F.timestamp_micros(F.col("_slot") * step).alias("bucket"),
        *keys,
        F.coalesce("n", F.lit(empty)).alias("n"),
    )


def moving_average(
    series: DataFrame,
    n: int = 10,
    include_current: bool = True,
    value: str = "n",
    keys: Sequence[str] = ("channel",),
) -> DataFrame:
    """Mean of the last n points of each series, in column `average`; `keys` name a series.

    Each day of a series is one window partition. The points that its first rows
    look back on are added to it from the days before.
    """
    lookback = n - 1 if include_current else n
    daily = series.withColumn("_day", F.date_trunc("day", "bucket"))
    point = F.struct("bucket", F.col(value).alias("_point"))
    day_end = Window.partitionBy(*keys, "_day").orderBy(F.desc("bucket"))
    tails = (
        daily.select(*keys, "_day", "bucket", value)
        .withColumn("_rank", F.row_number().over(day_end))
        .where(F.col("_rank") <= lookback)
        .groupBy(*keys, "_day")
        .agg(F.sort_array(F.collect_list(point)).alias("_tail"))
    )
    # A day has a point at least, so `lookback` days before hold enough of them.
    days_before = Window.partitionBy(*keys).orderBy("_day").rowsBetween(-lookback, -1)
    before = F.flatten(F.collect_list("_tail").over(days_before))
    lead_in = (
        tails.withColumn("_before", before)
        .withColumn("_skip", F.greatest(F.size("_before") - lookback, F.lit(0)))
        .select(
            *keys,
            "_day",
            F.explode(F.slice("_before", F.col("_skip") + 1, F.lit(lookback))).alias("_row"),
        )
        .select(
            *keys,
            "_day",
            "_row.bucket",
            F.col("_row._point").alias(value),
            F.lit(True).alias("_lead_in"),
        )
    )
    frame = Window.partitionBy(*keys, "_day").orderBy("bucket")
    frame = frame.rowsBetween(-lookback, 0 if include_current else -1)
    return (
        daily.withColumn("_lead_in", F.lit(False))
        .unionByName(lead_in, allowMissingColumns=True)
        .withColumn("average", F.avg(value).over(frame))
        .where(~F.col("_lead_in"))
        .select(*series.columns, "average")
    )


def running_count(df: DataFrame, order: Sequence[str] = ("ts", "id")) -> DataFrame:
    """Message number within the channel."""
    return numbered(df, order, "message_number", keys=["channel"])


def latest_n(df: DataFrame, n: int = 8, order: Sequence[str] = ("ts", "id")) -> DataFrame:
    """The last n messages of each channel, newest first in `recency`.

    Spark keeps n rows per channel in each task before the shuffle.
    """
    newest = Window.partitionBy("channel").orderBy(*[F.desc(c) for c in order])
    return df.withColumn("recency", F.row_number().over(newest)).where(F.col("recency") <= n)


def clustering_order(df: DataFrame) -> DataFrame:
    """Rows of the stored table in key order, range-partitioned over the whole key."""
    return df.repartitionByRange(*STORED_KEY).sortWithinPartitions(*STORED_KEY)
