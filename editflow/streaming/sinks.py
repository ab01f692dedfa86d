"""Queries that end in a table, several sinks or a callback.

A batch that is run again after a failure writes the same result: batches go to
folders of their own, or through the upsert.
"""

import json
import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.operators.counts import anomaly_counts, count_by_channel, with_totals
from editflow.operators.models import EPSILON, detect_anomalies
from editflow.operators.parse import edit_from_row, split_rejects
from editflow.operators.series import zero_fill
from editflow.session import list_paths, materialize, read_text, remove_path, scratch_scope
from editflow.sources.bus import decode_bus, encode_bus
from editflow.sources.edits import first_deliveries, stored_total, write_edits
from editflow.sources.log import compact
from editflow.sources.models import metric_rows

log = logging.getLogger(__name__)

Sink = Callable[[DataFrame, int], None]


def start(stream: DataFrame, sink: Sink, checkpoint: str, once: bool = False, mode="append"):
    """Run `sink` on each micro-batch; `once` stops after what is there now."""

    def scoped(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            sink(batch, batch_id)

    writer = stream.writeStream.outputMode(mode).foreachBatch(scoped)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def batch_folder(path: str) -> Sink:
    """A sink that writes each batch to its own folder, again if it is run again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def fan_out(df: DataFrame, sinks: list[Sink], checkpoint: str | None = None, once: bool = False):
    """Feed one frame or stream to several sinks; it is computed once per batch.

    For a stream the offsets are committed after all sinks are done.
    """

    def feed(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            whole = materialize(batch, "batch")
            for sink in sinks:
                sink(whole, batch_id)

    if df.isStreaming:
        return start(df, feed, checkpoint, once)
    return feed(df, 0)


def stream_store(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    codec: str = "json",
    once: bool = False,
    on_conflict: str = "replace",
    compact_every: int = 16,
    totals: str | None = None,
):
    """Decode frames and upsert them; offsets are committed after the store.

    The table knows the last batch of each query, so a batch that is run again is passed
    over. Every so many batches, small files are merged (0: never). `totals` gets the number
    of stored edits after each batch, as counter rows.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        good, _ = split_rejects(decode_bus(batch, codec))
        write_edits(good, path, on_conflict=on_conflict, batch=(query_of(spark, checkpoint), batch_id))
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(spark, path)
        if totals is not None:
            now = F.current_timestamp().alias("bucket")
            total = stored_total(spark, path).select(now, F.lit("inserted").alias("name"), "n")
            batch_folder(totals)(metric_rows(total), batch_id)

    return start(stream, store, checkpoint, once)


def query_of(spark: SparkSession, checkpoint: str) -> str:
    """The identity of the query that a checkpoint belongs to, whatever is started from it."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def stream_ingest(
    edits: DataFrame,
    bus: Sink,
    checkpoint: str,
    counts: Sink | None = None,
    codec: str = "json",
    once: bool = False,
    journal: str | None = None,
    published: Callable[[], DataFrame] | None = None,
):
    """Typed edits with `_ok` to the bus; rejects are counted but not published.

    With a journal (the path of an edit table) an edit is published once, however often it
    comes and however late. A batch that failed after a part of it was published is run
    again: `published` reads the frames that are on the bus, and the rest goes out. Without
    `published`, such a batch goes out whole; a sink that replaces a batch's frames needs none.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        good, _ = split_rejects(batch)
        if journal is None:
            bus(encode_bus(good, codec), batch_id)
            return
        spark = batch.sparkSession
        new, again = first_deliveries(good, journal, (query_of(spark, checkpoint), batch_id))
        frames = encode_bus(edit_from_row(new), codec)
        if again and published is not None:
            sent = published().select(_digest().alias("_digest")).distinct()
            frames = frames.withColumn("_digest", _digest()).join(sent, "_digest", "left_anti").drop("_digest")
        bus(frames, batch_id)

    return fan_out(edits, [publish] + ([counts] if counts else []), checkpoint, once)


def _digest() -> Column:
    return F.md5(F.concat(F.coalesce("key", F.lit(b"")), F.lit(b"|"), "value"))


def count_sink(path: str, interval: str = "10 seconds") -> Sink:
    """A sink that writes what a batch adds to the counts of each interval, channel and of all.

    Sums over the batches are the counts. Nothing waits for a watermark, so no edit is late;
    fed with first deliveries, no edit counts twice.
    """
    write = batch_folder(path)

    def count(batch: DataFrame, batch_id: int) -> None:
        write(with_totals(materialize(count_by_channel(batch, interval), "counts")), batch_id)

    return count


def stream_once(
    stream: DataFrame, path: str, checkpoint: str, sinks: list[Sink], codec: str = "json", once: bool = False
):
    """Decode frames, store them, and feed the sinks with the edits that are new to the table."""

    def feed(batch: DataFrame, batch_id: int) -> None:
        good, _ = split_rejects(decode_bus(batch, codec))
        query = query_of(batch.sparkSession, checkpoint)
        new, _ = first_deliveries(good, path, (query, batch_id))
        for sink in sinks:
            sink(new, batch_id)

    return start(stream, feed, checkpoint, once)


def stream_score(
    counts: DataFrame,
    models: DataFrame | Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    interval: str = "60 seconds",
    eps: float = EPSILON,
    once: bool = False,
):
    """Score each interval as it closes.

    `scored` below path gets the rows, `anomalies` the number of unusual intervals per
    channel as counter rows. `models` may be a function that loads them: it is called for
    each batch, so that models trained meanwhile count from the next batch on.
    Each batch also stores how far every channel has been scored, so that the next
    one can fill the empty intervals in between; a channel without edits counts 0.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        states = states_before(spark, f"{path}/state", batch_id)
        rows = batch.select("bucket", "channel", "n")
        if states:
            seen = spark.read.parquet(states[-1])
            marks = seen.select("bucket", "channel", F.lit(0).cast("bigint").alias("n"))
            done = seen.withColumnRenamed("bucket", "_done")
            new = F.col("_done").isNull() | (F.col("bucket") > F.col("_done"))
            filled = zero_fill(rows.unionByName(marks), interval)
            filled = filled.join(done, "channel", "left").where(new).drop("_done")
        else:
            filled = zero_fill(rows, interval)
        filled = materialize(filled, "filled")
        if filled.isEmpty():
            return
        known = materialize(models(), "models") if callable(models) else models
        batch_folder(f"{path}/scored")(detect_anomalies(filled, known, eps), batch_id)
        scored = spark.read.parquet(f"{path}/scored/batch={batch_id}")
        batch_folder(f"{path}/anomalies")(metric_rows(anomaly_counts(scored, interval)), batch_id)
        reached = filled.groupBy("channel").agg(F.max("bucket").alias("bucket"))
        reached.write.mode("overwrite").parquet(f"{path}/state/batch={batch_id}")
        # The state before this one is needed if this batch is run again.
        for old in states[:-1]:
            remove_path(spark, old)

    return start(counts, score, checkpoint, once)


def states_before(spark: SparkSession, path: str, batch_id: int) -> list[str]:
    """Folders of the states that batches before this one stored, in order; two at most."""
    listed = {int(found.rpartition("=")[2]): found for found in list_paths(spark, f"{path}/batch=*")}
    return [listed[number] for number in sorted(listed) if number < batch_id]


def on_flush(stream: DataFrame, fn: Sink, checkpoint: str, once: bool = False):
    """Call fn with the counts of each batch; an error in fn is logged and the query goes on.

    The counts are complete before fn runs, so their state is saved whatever fn does.
    """

    def call(batch: DataFrame, batch_id: int) -> None:
        complete = materialize(batch, "flush")
        try:
            fn(complete, batch_id)
        except Exception:
            log.exception("error in the flush callback of batch %s", batch_id)

    return start(stream, call, checkpoint, once)


def for_each_edit(stream: DataFrame, fn: Sink, checkpoint: str, once: bool = False):
    """Call fn with each batch of edits; an error stops the query, which can be restarted."""
    return start(stream, fn, checkpoint, once)
