"""End-to-end jobs: ingest, store, count, train, score and feed.

`bus` holds the options of the Kafka source or sink, or names another `format`.
The streaming jobs give their query; `once` stops it after what is there now.
"""

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.operators.counts import count_by_channel, with_totals
from editflow.operators.joins import route_edits
from editflow.operators.models import CLUSTERS, EPSILON, detect_anomalies, fit_all_models
from editflow.operators.parse import (
    assign_id,
    calendar_fields,
    parse_json_edits,
    split_rejects,
    typed_edits,
)
from editflow.operators.series import zero_fill
from editflow.session import materialize
from editflow.sources.bus import decode_bus, read_bus, write_bus
from editflow.sources.edits import read_edits
from editflow.sources.lines import json_lines, stream_lines
from editflow.sources.models import load_models, metric_rows, save_models
from editflow.streaming.counting import stream_counts
from editflow.streaming.sinks import (
    Sink,
    batch_folder,
    for_each_edit,
    start,
    stream_ingest,
    stream_once,
    stream_score,
    stream_store,
)
from editflow.streaming.stateful import stream_tallies


# How long an interval waits for edits that come out of order.
WATERMARK = "10 minutes"


def _edits(spark: SparkSession, bus: dict[str, str], codec: str, start: str = "committed"):
    good, _ = split_rejects(decode_bus(read_bus(spark, bus, start), codec))
    return good


def ingest(
    spark: SparkSession, landing: str, bus: dict[str, str], checkpoint: str, codec="json", once=False
):
    """JSON lines that land in a folder to the bus, at least once; bad lines are left out."""
    parsed = assign_id(parse_json_edits(stream_lines(spark, landing)))

    def publish(frames: DataFrame, batch_id: int) -> None:
        write_bus(frames, bus)

    return stream_ingest(parsed, publish, checkpoint, codec=codec, once=once)


def store(
    spark: SparkSession,
    bus: dict[str, str],
    table: str,
    checkpoint: str,
    codec="json",
    once=False,
    on_conflict: str = "keep",
    totals: str | None = None,
):
    """The bus to the stored table; `totals` gets the number of stored edits after each batch.

    Ids are made of the content, so a redelivered edit doesn't differ from the stored
    one, and no day is rewritten for it; on_conflict='replace' rewrites.
    """
    return stream_store(
        read_bus(spark, bus), table, checkpoint, codec, once, on_conflict, totals=totals
    )


def count(
    spark: SparkSession,
    bus: dict[str, str],
    path: str,
    checkpoint: str,
    interval: str = "10 seconds",
    watermark: str = WATERMARK,
    codec="json",
    once=False,
    table: str | None = None,
):
    """Counts per interval of every channel and of all messages, as metric rows.

    Empty intervals are reported, too. Edits that come after their interval was reported are
    rows of their own, which a counter adds up. An error in the store stops the query, and
    the batch is run again. With `table`, edits are stored there and only first deliveries
    count, however late a frame comes again; each batch then reports what it adds.
    """
    write = batch_folder(path)
    if table is not None:
        def add(batch: DataFrame, batch_id: int) -> None:
            counted = materialize(count_by_channel(batch, interval), "counts")
            write(metric_rows(with_totals(counted)), batch_id)

        return stream_once(read_bus(spark, bus), table, checkpoint, [add], codec, once)

    def flush(batch: DataFrame, batch_id: int) -> None:
        write(metric_rows(batch), batch_id)

    counts = stream_tallies(_edits(spark, bus, codec), interval, watermark, totals=True)
    return start(counts, flush, checkpoint, once)


def train(
    spark: SparkSession,
    table: str,
    model_path: str,
    week: int,
    channel: str | None = None,
    year: int | None = None,
    k: int = CLUSTERS,
    grain: str = "minute",
) -> None:
    """Fit and save the models of one ISO week, for one channel or all.

    Without an ISO year, the newest one counts in which the week has edits.
    """
    columns = ["channel", "year", "month", "week", "weekday", "hour", "day_minute"]
    edits = read_edits(spark, table, channel, week, columns, year)
    save_models(fit_all_models(edits, week, k, grain, year), model_path)


def score(
    spark: SparkSession,
    bus: dict[str, str],
    model_path: str,
    path: str,
    checkpoint: str,
    interval: str = "60 seconds",
    watermark: str = WATERMARK,
    eps: float = EPSILON,
    codec="json",
    once=False,
):
    """Counts of the bus against the saved models; a channel without a model is not scored.

    A frame that comes again within the watermark counts once. The models are loaded for each batch, so that a later `train` counts without a restart.
    """
    counts = stream_counts(_edits(spark, bus, codec), interval, watermark, unique=["id"])
    return stream_score(counts, lambda: load_models(spark, model_path), path, checkpoint, interval, eps, once)


def feed(
    spark: SparkSession,
    bus: dict[str, str],
    subscriptions: DataFrame,
    send: Sink,
    checkpoint: str,
    codec="json",
    once=False,
):
    """Live JSON of each edit for each subscriber of its channel, from now on."""

    def route(batch: DataFrame, batch_id: int) -> None:
        send(json_lines(route_edits(batch, subscriptions), "live", keep=["subscriber"]), batch_id)

    return for_each_edit(_edits(spark, bus, codec, start="latest"), route, checkpoint, once)


def train_and_score(
    lines: DataFrame,
    week: int,
    k: int = CLUSTERS,
    interval: str = "1 hour",
    grain: str = "hour",
    eps: float = EPSILON,
    year: int | None = None,
) -> DataFrame:
    """Learn normal activity from one ISO week and score the intervals after it, in one batch.

    `year` is the ISO year of the week; without it, the first one in which the week has
    edits. Intervals before the week are not scored, those of later years are. The
    lines are parsed once; training and counting read the two columns they need.
    """
    edits = materialize(typed_edits(lines).select("ts", "channel"), "edits")
    begin = _first_day(edits, week) if year is None else datetime.date.fromisocalendar(year, week, 1)
    if begin is None:
        begin = datetime.date.max - datetime.timedelta(days=7)
    end = F.lit(begin + datetime.timedelta(days=7)).cast("timestamp")
    trained = edits.where((F.col("ts") >= F.lit(begin).cast("timestamp")) & (F.col("ts") < end))
    models = fit_all_models(calendar_fields(trained), week, k, grain)
    counts = zero_fill(count_by_channel(edits, interval), interval)
    return detect_anomalies(counts.where(F.col("bucket") >= end), models, eps)


def _first_day(edits: DataFrame, week: int) -> datetime.date | None:
    """Monday of the first week with this ISO number that has edits."""
    first = edits.where(F.weekofyear("ts") == week).agg(F.min(F.to_date("ts"))).first()[0]
    return first and first - datetime.timedelta(days=first.weekday())
