"""Counts over streams."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from editflow.operators.counts import count_by_channel
from editflow.schema import ALL_MESSAGES


def stream_counts(
    stream: DataFrame,
    interval: str,
    watermark: str,
    time: str = "event",
    unique: list[str] | None = None,
) -> DataFrame:
    """Tumbling counts per channel, final once the watermark has passed an interval.

    An edit that comes later than the watermark is not counted, so the caller states
    it; a `LateRows` listener adds up how many there were. `stream_tallies` counts them, too.
    time='processing' counts by the moment of arrival instead of the edit's time.
    With `unique`, of rows with equal values in these columns one counts, as long as the
    others come within the watermark.
    """
    if time == "processing":
        stream = stream.withColumn("ts", F.current_timestamp())
    stream = stream.withWatermark("ts", watermark)
    if unique is not None:
        stream = stream.dropDuplicatesWithinWatermark(unique)
    return count_by_channel(stream, interval)


class LateRows(StreamingQueryListener):
    """Adds up the rows that each streaming query drops as too late, over all of its batches.

    Add it to `spark.streams` before the query starts. A query itself only reports its last
    batches, which `dropped_late` adds up.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        self.dropped[str(progress.id)] = self.dropped.get(str(progress.id), 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def dropped_late(query) -> int:
    """Rows that a streaming query has dropped as too late, of the last batches, which it still reports."""
    return sum(
        state.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )


def total_messages(stream: DataFrame) -> DataFrame:
    """Endless running count; write it in complete mode."""
    return stream.groupBy().agg(F.count("*").alias("n")).select(
        F.lit(ALL_MESSAGES).alias("name"), "n"
    )


def dedupe_redelivery(df: DataFrame, keys: list[str], watermark: str = "1 minute") -> DataFrame:
    """One row per key. A stream forgets a key when the watermark has passed it."""
    if df.isStreaming:
        return df.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)
