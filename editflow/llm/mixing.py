"""Copies of documents so that sources reach target shares of all words.

Entropy balancing: of all rates between 0 and CAP copies per document, those closest to
one copy each (in the relative entropy of a spread over 0 to CAP copies) that give every
source its target number of words have the form CAP / (1 + exp(-tilt * size / mean)),
with one tilt per source. The tilts solve a convex dual problem, one equation per source,
by Newton steps over a histogram of sizes, guarded by a bracket. Rates are then rounded
to whole copies along the sizes of a source, so that the errors cancel.

Only built-in expressions: no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editflow.functions.skew import numbered, running
from editflow.llm.tables import stored
from editflow.llm.words import WORD

SHARE = 1.5
CAP = 2
WEIGHTS = (5, 2, 1)
TOLERANCE = 1e-7
STEPS = 80
# Rates are whole multiples of 2 ** -BITS, so that sums are exact in any order.
BITS = 20
# Where the rounding of a source begins: the best of so many fractions of a copy.
PHASES = 16
# Sizes of a source are summed up in blocks of so many words.
BLOCK = 1024


def mixed(
    docs: DataFrame, share: float = SHARE, cap: int = CAP, weights: Sequence[int] = WEIGHTS
) -> DataFrame:
    """docs with size, source_size, target, rate, copies, taken; one row per row of docs.

    size: words of the text, 0 if null or empty. Sources by code point, null last, weigh
    `weights`, repeating, and share `share` of all words; a target stops at `cap` times
    its source's size, and the excess is shared again. taken = copies * size, copies from
    0 to `cap`. Equal rows may get different numbers of copies; which of them gets which
    is the same in all runs, as the rows are equal. Without any word all targets are 0.
    Columns of docs with the names of new ones are replaced.
    """
    sized = docs.drop("size", "source_size", "target", "rate", "copies", "taken")
    source = F.col("source").cast("string")
    columns = {
        "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
        "_source": F.when(source.isNull(), F.lit("~")).otherwise(F.concat(F.lit("="), source)),
    }
    kept = [c for c in sized.columns if c != "text"]
    # Texts are read once for their size; whoever needs them joins them again.
    sized = stored(sized.withColumns(columns).select(*kept, "size", "_source"), "sized")
    goals = stored(targets(sized, share, cap, weights), "goals")
    cells = stored(sized.groupBy("_source", "size").agg(F.count("*").alias("n")), "cells")
    tilt = tilts(cells, goals, cap)
    rated = cells.join(tilt, "_source").withColumn(
        "_unit", F.floor(_rate(cap) * (1 << BITS) + 0.5).cast("long")
    )
    rated = rated.select(
        "_source", "size", "_unit", "source_size", "target", "n",
        (F.col("n") * F.col("_unit")).alias("_units"),
        F.floor(F.col("size") / BLOCK).cast("long").alias("_block"),
    )
    rated = stored(rated, "rated")
    before = running(rated, ["_source"], "_block", "size", "_units", "_upto")
    before = before.withColumn("_base", F.col("_upto") - F.col("_units"))
    before = _phased(stored(before, "before")).select(
        "_source", "size", "_unit", "source_size", "target", "_base"
    )
    ranked = numbered(
        sized.withColumn("_order", F.xxhash64("doc_id")), ["_order", "doc_id"], "_rank", ["_source", "size"]
    )
    rows = ranked.join(before, ["_source", "size"])
    copies = _whole(F.col("_rank")) - _whole(F.col("_rank") - 1)
    return (
        rows.withColumn("copies", copies.cast("long"))
        .withColumn("rate", F.col("_unit") / F.lit(1 << BITS))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select(*kept, "size", "source_size", "target", "rate", "copies", "taken")
    )


def _whole(rank: Column) -> Column:
    """Copies given to the first `rank` documents of a size and to all of smaller sizes."""
    return F.shiftright(F.col("_base") + rank * F.col("_unit"), BITS)


def _phased(before: DataFrame) -> DataFrame:
    """_base moved by that of PHASES fractions of a copy that brings its source nearest to its target."""
    tried = [k * (1 << BITS) // PHASES for k in range(PHASES)]

    def words(phase: int) -> Column:
        end = F.shiftright(F.col("_base") + F.col("_units") + phase, BITS)
        return F.sum(F.col("size") * (end - F.shiftright(F.col("_base") + phase, BITS)))

    sums = before.groupBy("_source").agg(
        F.first("target").alias("goal"), *(words(x).alias(f"w{x}") for x in tried)
    )
    gaps = [F.struct(F.abs(F.col(f"w{x}") - F.col("goal")), F.lit(x).alias("phase")) for x in tried]
    best = sums.select("_source", F.array_min(F.array(*gaps)).getField("phase").alias("_phase"))
    return before.join(best, "_source").withColumn("_base", F.col("_base") + F.col("_phase"))


def targets(sized: DataFrame, share: float, cap: int, weights: Sequence[int]) -> DataFrame:
    """_source, source_size, target per source."""
    sums = sized.groupBy("_source").agg(F.sum("size").alias("source_size"))
    sums = sums.withColumn("_null", (F.col("_source") == "~").cast("int"))
    ranked = numbered(sums, ["_null", "_source"], "_number").drop("_null")
    listed = F.array(*(F.lit(int(w)) for w in weights))
    ranked = stored(
        ranked.withColumn("weight", listed[((F.col("_number") - 1) % len(weights)).cast("int")]), "sources"
    )
    total = share * float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    most = F.col("source_size") * cap
    level = 0.0
    while True:  # each round stops at least one more source at its cap
        full = most < F.col("weight") * F.lit(level)
        stopped, open_weight = ranked.agg(
            F.sum(F.when(full, most).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        now = (total - float(stopped or 0)) / open_weight if open_weight else level
        if now <= level:
            break
        level = now
    goal = F.least(most.cast("double"), F.col("weight") * F.lit(level))
    return ranked.select("_source", "source_size", goal.alias("target"))


def _rate(cap: int) -> Column:
    free = F.lit(float(cap)) / (1 + F.exp(-F.least(F.lit(700.0), F.greatest(F.lit(-700.0), _tilted()))))
    return F.when(F.col("fixed").isNotNull(), F.col("fixed")).otherwise(free)


def _tilted() -> Column:
    return F.col("tilt") * F.col("size") / F.col("mean")


def tilts(cells: DataFrame, goals: DataFrame, cap: int) -> DataFrame:
    """goals with mean, tilt and fixed (the rate of a source that is full, or without words)."""
    counts = cells.groupBy("_source").agg(F.sum("n").alias("docs"))
    level = F.col("target") / (F.col("source_size") * cap)
    start = goals.join(counts, "_source").select(
        "_source",
        "source_size",
        "target",
        (F.col("source_size") / F.col("docs")).alias("mean"),
        F.when((F.col("source_size") == 0) | (F.col("target") <= 0), 0.0)
        .when(level >= 1, float(cap))
        .alias("fixed"),
        F.when((level > 0) & (level < 1), F.log(level / (1 - level))).otherwise(0.0).alias("tilt"),
        F.lit(-1e9).alias("low"),
        F.lit(1e9).alias("high"),
    )
    state = stored(start, "tilts")
    for _ in range(STEPS):
        given = _rate(cap)
        words = F.col("n") * F.col("size")
        slope = words * F.col("size") / F.col("mean") * given * (1 - given / cap)
        sums = cells.join(state.where("fixed is null"), "_source").groupBy("_source").agg(
            F.sum((words * given).cast("decimal(30,6)")).cast("double").alias("words"),
            F.sum(slope.cast("decimal(30,6)")).cast("double").alias("slope"),
        )
        over = F.col("words") - F.col("target")
        low = F.when(over < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(over > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("tilt") - over / F.col("slope"))
        near = F.abs(over) <= F.lit(TOLERANCE) * F.col("target")
        stepped = state.join(sums, "_source", "left").select(
            "_source", "source_size", "target", "mean", "fixed",
            F.when(near | F.col("words").isNull(), F.col("tilt"))
            .when((newton > low) & (newton < high), newton)
            .otherwise((low + high) / 2)
            .alias("tilt"),
            F.coalesce(low, "low").alias("low"),
            F.coalesce(high, "high").alias("high"),
            F.coalesce(~near, F.lit(False)).alias("open"),
        )
        stepped = stored(stepped, "tilts")
        if stepped.where("open").isEmpty():
            break
        state = stepped.drop("open")
    return state.select("_source", "source_size", "target", "mean", "fixed", "tilt")
