"""Operators with a state of their own per name: counters that report every interval and lose nothing.

Python's `transformWithState` keeps the state in RocksDB. Rows are combined inside their
task before the shuffle, so a hot name sends one row per task and interval, not its edits.
"""

from collections.abc import Iterable, Iterator, Sequence
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from editflow.functions.intervals import interval_micros
from editflow.operators.metrics import chained_gauges, gauge_events
from editflow.schema import ALL_MESSAGES
from editflow.session import keep_state_in_rocksdb

# Rows that a task holds before it sends its partial counts on, and rows of one frame of output.
COMBINED = 100_000
FRAME = 10_000

TALLY = "bucket timestamp, name string, n long, late boolean"


def stream_tallies(
    stream: DataFrame,
    interval: str,
    watermark: str,
    start: int = 0,
    predicate: Column | None = None,
    name: Column | None = None,
    totals: bool = False,
) -> DataFrame:
    """Counts per name (the channel) and interval: bucket, name, n, late.

    Once the watermark has passed an interval, it gets a row with late = false, `start` plus
    the rows that came so far; so does each empty interval, from a name's first one on. Rows
    that come later than that are not dropped: they are reported at once with late = true,
    without `start`. The sum of n over a bucket and name (see `settled`) is `start` plus the
    number of rows, however late they come.

    With a predicate, only rows that satisfy it count, but all open intervals. `totals` adds
    a counter of all rows. Rows without ts are left out.
    """
    keep_state_in_rocksdb(stream.sparkSession)
    step = interval_micros(interval)
    counted = F.lit(1) if predicate is None else F.coalesce(predicate, F.lit(False)).cast("int")
    rows = stream.withWatermark("ts", watermark).select(
        (F.col("channel") if name is None else name).alias("name"),
        F.floor(F.unix_micros("ts") / F.lit(step)).alias("slot"),
        counted.cast("long").alias("n"),
    )
    # The columns that come out are no longer bound to the watermark, so no late row is dropped.
    combined = rows.where("slot is not null").mapInArrow(
        partial(_combine, totals=totals), "name string, slot long, n long"
    )
    return combined.groupBy("name").transformWithStateInPandas(
        Tally(step, start), outputStructType=TALLY, outputMode="Append", timeMode="EventTime"
    )


def settled(tallies: DataFrame) -> DataFrame:
    """One row per interval and name of all that was reported, late rows added in."""
    return tallies.groupBy("bucket", "name").agg(F.sum("n").alias("n"))


def _combine(batches: Iterable[pa.RecordBatch], totals: bool) -> Iterator[pa.RecordBatch]:
    """Partial sums of a task by name and slot."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held.append(table)
        if totals:
            both = pa.array([ALL_MESSAGES] * len(table), table.schema.field("name").type)
            held.append(table.set_column(0, "name", both))
        size += len(table)
        if size >= COMBINED:
            held = [_sums(held)]
            yield from held[0].to_batches()
            held, size = [], 0
    if held:
        yield from _sums(held).to_batches()


def _sums(tables: list[pa.Table]) -> pa.Table:
    summed = pa.concat_tables(tables).group_by(["name", "slot"]).aggregate([("n", "sum")])
    return pa.table({"name": summed["name"], "slot": summed["slot"], "n": summed["n_sum"]})


class Tally(StatefulProcessor):
    """State of one name: counts of the open slots, the first slot of all, and the next one to report.

    A timer stands at the end of the next slot. Slots are interval numbers since 1970.
    """

    def __init__(self, step: int, start: int) -> None:
        self.step, self.start = step, start

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "slot long", "n long")
        self.span = handle.getValueState("span", "first long, next long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        counts: dict[int, int] = {}
        for frame in rows:
            for slot, n in zip(frame["slot"].tolist(), frame["n"].tolist()):
                counts[slot] = counts.get(slot, 0) + n
        low = min(counts)
        if not self.span.exists():
            first = after = low
            self._wait(after)
        else:
            first, after = self.span.get()
            if low < first and after == first:  # nothing is reported yet
                self.handle.deleteTimer(self._end(after))
                first = after = low
                self._wait(after)
        before = range(low, first)
        yield from self._frames(key[0], before, {s: counts.pop(s, 0) for s in before} if before else {})
        late = {slot: n for slot, n in counts.items() if first <= slot < after}
        yield from self._late(key[0], late)
        for slot, n in counts.items():
            if slot >= after:
                held = self.open.getValue((slot,))[0] if self.open.containsKey((slot,)) else 0
                self.open.updateValue((slot,), (held + n,))
        self.span.update((min(first, low), after))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first, after = self.span.get()
        passed = max(after, timerValues.getCurrentWatermarkInMs() * 1000 // self.step)
        # Open slots are those that the watermark has not passed, few if it stays close.
        counts = {k[0]: v[0] for k, v in self.open.iterator() if k[0] < passed}
        yield from self._frames(key[0], range(after, passed), counts)
        for slot in counts:
            self.open.removeKey((slot,))
        self.span.update((first, passed))
        self._wait(passed)

    def _end(self, slot: int) -> int:
        """Last millisecond of a slot."""
        return (slot + 1) * self.step // 1000 - 1

    def _wait(self, slot: int) -> None:
        self.handle.registerTimer(self._end(slot))

    def _frames(self, name: str, slots: range, counts: dict[int, int]) -> Iterator[pd.DataFrame]:
        """First reports of consecutive slots."""
        for begin in range(0, len(slots), FRAME):
            part = slots[begin : begin + FRAME]
            yield self._frame(name, list(part), [self.start + counts.get(s, 0) for s in part], False)

    def _late(self, name: str, counts: dict[int, int]) -> Iterator[pd.DataFrame]:
        some = {slot: n for slot, n in counts.items() if n}
        if some:
            yield self._frame(name, list(some), list(some.values()), True)

    def _frame(self, name: str, slots: list[int], counts: list[int], late: bool) -> pd.DataFrame:
        at = pd.to_datetime([s * self.step for s in slots], unit="us")
        return pd.DataFrame({"bucket": at, "name": name, "n": counts, "late": late})


def stream_gauges(
    stream: DataFrame, interval: str = "10 seconds", value: str = "value", order: Sequence[str] = ("ts", "event_id")
) -> DataFrame:
    """What each batch changes in the gauges: bucket, name, base, moved, revision.

    `base` is the last value set in the interval, null if none was; `moved` is the sum of the
    adjustments after it. A row replaces those of its bucket and name with a smaller revision.
    A name and interval keeps the last set value and, in order, the adjustments after it: what
    lies before is overwritten for good. So events may come in any order, however late.
    `gauge_values` gives the values. Rows without ts are left out.

    `order` is a timestamp and a whole number, as in `metric_gauge`.
    """
    keep_state_in_rocksdb(stream.sparkSession)
    sent = gauge_events(stream, interval, value).select(
        "bucket", "name", F.unix_micros(order[0]).alias("at"), F.col(order[1]).cast("long").alias("turn"), "adjusts", "amount"
    )
    return sent.where("bucket is not null").groupBy("bucket", "name").transformWithStateInPandas(
        Gauge(), outputStructType=GAUGE, outputMode="Append", timeMode="None"
    )


def gauge_values(changes: DataFrame) -> DataFrame:
    """Value of each gauge at the end of each interval in which it was sent, as `metric_gauge` gives it."""
    parts = ("base", "moved")
    last = changes.groupBy("bucket", "name").agg(F.max_by(F.struct(*parts), "revision").alias("_last"))
    return chained_gauges(last.select("bucket", "name", *[F.col(f"_last.{p}").alias(f"_{p}") for p in parts]))


GAUGE = "bucket timestamp, name string, base double, moved double, revision long"


class Gauge(StatefulProcessor):
    """State of one name and interval: the last set value with its place, and the adjustments after it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at long, turn long, base double, revision long")
        self.after = handle.getListState("after", "at long, turn long, amount double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        at, turn, base, revision = self.last.get() if self.last.exists() else (None, None, None, 0)
        place = (at, turn) if at is not None else None
        moves = [tuple(move) for move in self.after.get()] if self.after.exists() else []
        for frame in rows:
            for one in frame.itertuples(index=False):
                if one.adjusts:
                    moves.append((one.at, one.turn, one.amount))
                elif place is None or (one.at, one.turn) > place:
                    place, base = (one.at, one.turn), one.amount
        # What lies before the last set value can't count any more, nor can it ever again.
        moves = sorted(m for m in moves if place is None or m[:2] > place)
        at, turn = place or (None, None)
        self.last.update((at, turn, base, revision + 1))
        if moves:
            self.after.put(moves)
        elif self.after.exists():
            self.after.clear()
        moved = float(sum(m[2] for m in moves))
        yield pd.DataFrame(
            {"bucket": [key[0]], "name": [key[1]], "base": [base], "moved": [moved], "revision": [revision + 1]}
        )
