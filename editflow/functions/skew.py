"""Joins and windows that stay spread out when one key holds much of the data."""

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editflow.session import materialize

# A lookup side is broadcast only if it has been measured and has no more rows and bytes than this.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
    parts: int | None = None,
) -> DataFrame:
    """Join a large frame with a lookup frame, inner or left.

    A lookup of a checked size is broadcast and the large side does not move. Beyond that
    size both sides move. Keys that hold more than one of `parts` equal shares of the rows
    (the shuffle partitions, if not given), which are fewer than `parts`, are then dealt
    by `spread` over as many salts as they hold shares; only their lookup rows are repeated.
    """
    on = list(on)
    count, written = lookup.agg(F.count("*"), F.coalesce(F.sum(_bytes(lookup)), F.lit(0))).first()
    if count <= broadcast_rows and written <= BROADCAST_BYTES:
        return rows.join(F.broadcast(lookup), on, how)
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = materialize(rows.groupBy(*on).agg(F.count("*").alias("_held")), "held")
    total = held.select(F.sum("_held")).scalar()
    share = F.col("_held") * parts / total
    hot = F.broadcast(held.where(share > 1).select(*on, F.ceil(share).alias("_salts")))
    salt = F.pmod(F.xxhash64(*spread), F.coalesce("_salts", F.lit(1)))
    salted = rows.join(hot, on, "left").withColumn("_salt", salt).drop("_salts")
    salts = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = lookup.join(hot, on, "left").withColumn("_salt", F.explode(salts)).drop("_salts")
    return salted.join(repeated, on + ["_salt"], how).drop("_salt")


def _bytes(lookup: DataFrame) -> Column:
    """Bytes of a row: as text, lists of longs as they are."""
    lists = [f.name for f in lookup.schema.fields if f.dataType.simpleString() == "array<bigint>"]
    rest = F.octet_length(F.to_json(F.struct(*[c for c in lookup.columns if c not in lists])))
    return sum([F.coalesce(F.size(c), F.lit(0)) * 8 for c in lists], rest)


def running(
    rows: DataFrame,
    keys: Sequence[str],
    block: str,
    order: str,
    value: str,
    out: str,
    aggregate: Callable[[str], Column] = F.sum,
) -> DataFrame:
    """Running sum or maximum of `value` per key, in two levels.

    `block` is a column that rises with `order` and bounds the rows of one block.
    Each block runs on its own; the blocks are combined from one row per block.
    """
    keys = list(keys)
    per_block = rows.groupBy(*keys, block).agg(aggregate(value).alias("_block_value"))
    earlier = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    before = per_block.select(
        *keys, block, aggregate("_block_value").over(earlier).alias("_before")
    )
    inside = Window.partitionBy(*keys, block).orderBy(order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = aggregate(value).over(inside)
    if aggregate is F.sum:
        combined = F.coalesce(F.col("_before"), F.lit(0)) + F.col("_here")
    else:
        combined = F.greatest("_before", "_here")
    return (
        rows.withColumn("_here", here)
        .join(before, keys + [block])
        .withColumn(out, combined)
        .drop("_here", "_before")
    )


def placed(rows: DataFrame, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows range-sorted over keys and order, with their partition and place in it.

    The read position is the last resort of the order, so that exact copies also
    spread. The sorted rows are written out: later passes must see the same
    partitions.
    """
    ranged = (
        rows.withColumn("_read", F.monotonically_increasing_id())
        .orderBy(*keys, *order, "_read")
        .drop("_read")
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", 33))
    )
    return materialize(ranged, "placed")


def numbered(
    rows: DataFrame, order: Sequence[str], out: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Row numbers from 1 in `order`, per key, without one task per key.

    A row's number is its place in its own partition plus the number of rows of
    its key in the partitions before it.
    """
    keys = list(keys)
    ranged = placed(rows, order, keys)
    runs = ranged.groupBy(*keys, "_part").agg(
        F.count("*").alias("_size"), F.min("_place").alias("_first")
    )
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first") + 1
    runs = materialize(runs.select(*keys, "_part", shift.alias("_shift")), "runs")
    return (
        lookup_join(ranged, runs, keys + ["_part"], spread=["_place"])
        .withColumn(out, F.col("_place") + F.col("_shift"))
        .drop("_place", "_part", "_shift")
    )


def as_of(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    since: str,
    version: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """rows with the columns `version` of the newest version of their keys whose `since` is not after `at`.

    Rows and versions are range-sorted together over keys and time, so a hot key is dealt
    over many tasks. In each partition a version is carried down to the rows below it, and
    the last one of a key is carried on to the key's later partitions. Rows before the first
    version of their keys drop out, with how='left' they stay with nulls; rows with a null key
    or time drop out.
    """
    keys, payload = list(keys), F.struct(*version)
    old = versions.select(
        *keys, F.col(since).alias("_at"), payload.alias("_version"), F.lit(None).alias("_row")
    )
    row = F.struct(*rows.columns)
    new = rows.where(F.col(at).isNotNull()).select(
        *keys, F.col(at).alias("_at"), F.lit(None).alias("_version"), row.alias("_row")
    )
    both = old.where(F.col("_at").isNotNull()).unionByName(new).where(
        functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    )
    # At the same time, versions come before rows: false sorts before true.
    both = both.withColumn("_is_row", F.col("_row").isNotNull())
    ranged = placed(both, ["_at", "_is_row"], keys)
    inside = Window.partitionBy(*keys, "_part").orderBy("_place")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = ranged.withColumn("_here", F.last("_version", ignorenulls=True).over(inside))
    ends = ranged.groupBy(*keys, "_part").agg(F.max_by("_version", F.when(~F.col("_is_row"), F.col("_place"))).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.last("_end", ignorenulls=True).over(earlier).alias("_before")
    before = materialize(ends.select(*keys, "_part", before).where("_before is not null"), "carried")
    found = lookup_join(carried.where("_is_row"), before, keys + ["_part"], ["_place"], "left")
    found = found.withColumn("_version", F.coalesce("_here", "_before"))
    if how == "inner":
        found = found.where("_version is not null")
    return found.select("_row.*", *[F.col("_version")[c].alias(c) for c in version])
