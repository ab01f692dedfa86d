"""The live feed: message numbers, every n-th message, and the newest messages of each channel."""

import json
from collections.abc import Iterable, Iterator, Sequence
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from editflow.functions.skew import lookup_join, numbered
from editflow.session import keep_state_in_rocksdb, materialize, remove_path
from editflow.streaming.sinks import batch_folder, start, states_before

# Messages that a task looks at before it sends the newest of each channel on.
COMBINED = 50_000


def stream_numbered(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = ("channel",),
    order: Sequence[str] = ("ts", "id"),
    out: str = "message_number",
    every: int = 1,
    once: bool = False,
):
    """Number messages as they arrive, per channel (or `keys`), from 1: `rows` below path.

    Inside a batch they are numbered in `order`, by a range sort with counts per partition, so
    a hot channel is dealt over many tasks. How far each key has come is stored with each
    batch and handed on to the next; a batch that is run again gets the same numbers. With
    `every`, only rows whose number leaves a remainder of 1 are written: with keys=() the
    first, and every n-th message of the stream after it.
    """
    keys = list(keys)

    def number(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        states = states_before(spark, f"{path}/state", batch_id)
        rows = numbered(batch, order, out, keys)
        if states and keys:
            reached = spark.read.parquet(states[-1])
            rows = lookup_join(rows, reached, keys, list(order), "left")
            rows = rows.withColumn(out, F.col(out) + F.coalesce("_reached", F.lit(0))).drop("_reached")
        elif states:
            rows = rows.withColumn(out, F.col(out) + spark.read.parquet(states[-1]).first()["_reached"])
        rows = materialize(rows, "numbered")
        chosen = rows if every == 1 else rows.where(F.col(out) % every == 1)
        batch_folder(f"{path}/rows")(chosen, batch_id)
        now = rows.groupBy(*keys).agg(F.max(out).alias("_reached")).where("_reached is not null")
        if states:
            now = now.unionByName(spark.read.parquet(states[-1]))
            now = now.groupBy(*keys).agg(F.max("_reached").alias("_reached"))
        now.write.mode("overwrite").parquet(f"{path}/state/batch={batch_id}")
        # The state before this one is needed if this batch is run again.
        for old in states[:-1]:
            remove_path(spark, old)

    return start(stream, number, checkpoint, once)


LATEST = "channel string, recency int, ts timestamp, id string, message string, revision long"


def stream_latest(stream: DataFrame, n: int = 8) -> DataFrame:
    """The n newest messages of each channel that a batch has changed, newest first in `recency`.

    Rows of a channel replace those with a smaller revision, see `latest_messages`. `message`
    is the whole row as JSON. Each task sends on only the n newest of a channel, so the state
    of a hot channel gets n rows per task, not its messages. Rows without ts are left out.
    """
    keep_state_in_rocksdb(stream.sparkSession)
    rows = stream.where("ts is not null").select(
        "channel", F.unix_micros("ts").alias("at"), "id", F.to_json(F.struct("*")).alias("message")
    )
    layout = "channel string, at long, id string, message string"
    newest = rows.mapInArrow(partial(_newest, n=n), layout)
    return newest.groupBy("channel").transformWithStateInPandas(
        Newest(n), outputStructType=LATEST, outputMode="Append", timeMode="None"
    )


def latest_messages(changes: DataFrame) -> DataFrame:
    """The rows of each channel's last revision."""
    last = Window.partitionBy("channel").orderBy(F.desc("revision"))
    return changes.withColumn("_age", F.rank().over(last)).where("_age = 1").drop("_age", "revision")


def _newest(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    held: pd.DataFrame | None = None
    layout: pa.Schema | None = None
    size = 0
    for batch in batches:
        layout = batch.schema
        held = _top(pd.concat([held, batch.to_pandas()] if held is not None else [batch.to_pandas()]), n)
        size += batch.num_rows
        if size >= COMBINED:
            yield pa.RecordBatch.from_pandas(held, layout, preserve_index=False)
            held, size = None, 0
    if held is not None and len(held):
        yield pa.RecordBatch.from_pandas(held, layout, preserve_index=False)


def _top(rows: pd.DataFrame, n: int) -> pd.DataFrame:
    rows = rows.sort_values(["at", "id"], ascending=False, kind="stable")
    return rows.groupby("channel", sort=False, dropna=False).head(n)


class Newest(StatefulProcessor):
    """State of a channel: its n newest messages and the number of times they changed."""

    def __init__(self, n: int) -> None:
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("newest", "rows string, revision long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known, revision = self.state.get() if self.state.exists() else ("[]", 0)
        found = [tuple(row) for row in json.loads(known)]
        before = list(found)
        for frame in rows:
            found += zip(frame["at"].tolist(), frame["id"].tolist(), frame["message"].tolist())
        found = sorted(found, key=lambda row: (row[0], row[1] or ""), reverse=True)[: self.n]
        if found == before:
            return
        self.state.update((json.dumps(found), revision + 1))
        at, ids, messages = zip(*found)
        yield pd.DataFrame(
            {
                "channel": key[0],
                "recency": range(1, len(found) + 1),
                "ts": pd.to_datetime(list(at), unit="us"),
                "id": ids,
                "message": messages,
                "revision": revision + 1,
            }
        )
