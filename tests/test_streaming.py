"""Streams give what the batch operators give."""

import datetime
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from editflow.operators import counts, models, series
from editflow.schema import BUS, EDIT_COLUMNS, MODEL
from editflow.session import checkpoint_root
from editflow.sources import bus, edits as table
from editflow.streaming import counting, sinks
from tests.data import at, edit_frame, skewed_events
from tests.test_skew import events

SCHEMA = "id string, ts timestamp, channel string"


def in_files(spark, folder, rows, parts):
    """Events in time order, one file per part, to be read one file per batch."""
    path = folder("landing")
    ordered = sorted(rows, key=lambda r: r[1])
    size = -(-len(ordered) // parts)
    for i in range(parts):
        part = events(spark, ordered[i * size : (i + 1) * size]).coalesce(1)
        part.write.mode("append").parquet(path)
    return path


def stream(spark, path, schema=SCHEMA):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def closed(batch, newest, interval):
    return batch.where(F.col("bucket") + F.expr(f"interval {interval}") <= F.lit(newest))


def test_stream_counts_equal_the_batch_for_closed_intervals(spark, folder):
    rows = skewed_events(800)
    path, out = in_files(spark, folder, rows, 5), folder("out")
    counted = counting.stream_counts(stream(spark, path), "1 hour", "0 seconds")
    sinks.start(counted, sinks.batch_folder(out), folder("offsets"), once=True).awaitTermination()
    batch = counts.count_by_channel(spark.read.parquet(path), "1 hour")
    newest = spark.read.parquet(path).agg(F.max("ts")).first()[0]
    expected = sorted(map(tuple, closed(batch, newest, "1 hour").collect()))
    got = spark.read.parquet(out).select("bucket", "channel", "n").collect()
    assert sorted(map(tuple, got)) == expected


def test_processing_time_counts(spark, folder):
    path, out = in_files(spark, folder, skewed_events(50), 1), folder("out")
    counted = counting.stream_counts(stream(spark, path), "1 hour", "0 seconds", time="processing")
    query = sinks.start(counted, sinks.batch_folder(out), folder("offsets"), once=True, mode="update")
    query.awaitTermination()
    got = spark.read.parquet(out)
    assert got.agg(F.sum("n")).first()[0] == 50
    assert got.agg(F.min("bucket")).first()[0].year >= 2025


def test_stream_score_fills_between_batches_and_survives_a_rerun(spark, folder):
    rows = [(f"i{n}", s, c) for n, (_, s, c) in enumerate(skewed_events(300))]
    path, out, offsets = in_files(spark, folder, rows, 6), folder("out"), folder("offsets")
    trained = spark.createDataFrame([("#en.wikipedia", 2024, 1, 0, 2.0), ("#c1.wikipedia", 2024, 1, 0, 0.0)], MODEL)
    counted = counting.stream_counts(stream(spark, path), "1 hour", "0 seconds")
    sinks.stream_score(counted, trained, out, offsets, "1 hour", once=True).awaitTermination()
    # A second run finds nothing new.
    sinks.stream_score(counted, trained, out, offsets, "1 hour", once=True).awaitTermination()
    newest = spark.read.parquet(path).agg(F.max("ts")).first()[0]
    batch = closed(counts.count_by_channel(spark.read.parquet(path), "1 hour"), newest, "1 hour")
    expected = models.detect_anomalies(series.zero_fill(batch, "1 hour"), trained)
    shown = ["bucket", "channel", "n", "centre", "is_anomaly"]
    got = spark.read.parquet(f"{out}/scored").select(*shown).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected.select(*shown).collect()))
    batches = spark.read.parquet(f"{out}/scored").select("batch").distinct().count()
    assert batches > 2
    # The state of the last batch and of the one before it, whatever the number of batches.
    assert spark.read.parquet(f"{out}/state").select("batch").distinct().count() == 2


def test_stream_store_and_restart(spark, folder):
    landing, path, offsets = folder("bus"), folder("edits"), folder("offsets")
    edits = edit_frame(spark, 120)
    options = {"format": "parquet", "path": landing}
    bus.write_bus(bus.encode_bus(edits.limit(70)), options)
    sinks.stream_store(bus.read_bus(spark, options), path, offsets, once=True).awaitTermination()
    # The rest arrives together with a redelivery of all frames before it.
    bus.write_bus(bus.encode_bus(edits), options)
    sinks.stream_store(bus.read_bus(spark, options), path, offsets, once=True).awaitTermination()
    got = table.read_edits(spark, path).select(*EDIT_COLUMNS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, edits.collect()))


def test_scratch_tables_go_with_their_batch(spark, folder):
    landing, path = folder("bus"), folder("edits")
    edits, options = edit_frame(spark, 60), {"format": "parquet", "path": landing}
    table.write_edits(edits.limit(20), path)
    bus.write_bus(bus.encode_bus(edits), options)
    root = checkpoint_root(spark).removeprefix("file:")
    before = {name for name in os.listdir(root) if "batch" in name or "merged" in name}
    sinks.stream_store(bus.read_bus(spark, options), path, folder("offsets"), once=True).awaitTermination()
    after = {name for name in os.listdir(root) if "batch" in name or "merged" in name}
    assert after == before
    assert table.read_edits(spark, path).count() == 60


def test_stream_ingest_counts_but_does_not_publish_rejects(spark, folder):
    from editflow.operators.parse import assign_id, parse_json_edits
    from editflow.sources.lines import stream_lines, write_json_lines

    landing, out, totals = folder("lines"), folder("bus"), folder("totals")
    write_json_lines(edit_frame(spark, 40), landing)
    spark.createDataFrame([("oops",), (json.dumps({"a": 1}),)], "value string").write.mode("append").text(landing)
    parsed = assign_id(parse_json_edits(stream_lines(spark, landing)))

    def total(batch, batch_id):
        sinks.batch_folder(totals)(counts.count_items(batch), batch_id)

    sinks.stream_ingest(parsed, sinks.batch_folder(out), folder("offsets"), total, once=True).awaitTermination()
    seen = spark.read.parquet(totals).agg(F.sum("items"), F.sum("accepted"), F.sum("rejected")).first()
    assert tuple(seen) == (42, 40, 2)
    assert spark.read.schema(BUS).parquet(out).count() == 40


def test_dedupe_redelivery(spark, folder):
    rows = [(f"i{n}", n, "#c.wikipedia") for n in range(100)]
    path, out = in_files(spark, folder, rows + rows, 4), folder("out")
    unique = counting.dedupe_redelivery(stream(spark, path), ["id"], "1 minute")
    sinks.start(unique, sinks.batch_folder(out), folder("offsets"), once=True).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == sorted(r[0] for r in rows)
    batch = counting.dedupe_redelivery(spark.read.parquet(path), ["id"])
    assert batch.count() == 100


def test_total_messages(spark, folder):
    path, seen = in_files(spark, folder, skewed_events(90), 3), []

    def note(batch, batch_id):
        seen.append(batch.first().n)

    total = counting.total_messages(stream(spark, path))
    sinks.start(total, note, folder("offsets"), once=True, mode="complete").awaitTermination()
    assert seen == [30, 60, 90]


def test_an_error_in_a_flush_callback_does_not_stop_the_counts(spark, folder):
    path, seen = in_files(spark, folder, skewed_events(90), 3), []

    def flush(batch, batch_id):
        seen.append(batch_id)
        raise ValueError("callback")

    counted = counting.stream_counts(stream(spark, path), "1 hour", "0 seconds")
    sinks.on_flush(counted, flush, folder("offsets"), once=True).awaitTermination()
    assert len(seen) >= 3


def test_an_error_in_an_edit_callback_stops_the_query(spark, folder):
    path, offsets, seen = in_files(spark, folder, skewed_events(60), 2), folder("offsets"), []

    def fail(batch, batch_id):
        raise ValueError("callback")

    def collect(batch, batch_id):
        seen.append((batch_id, batch.count()))

    with pytest.raises(Exception, match="callback"):
        sinks.for_each_edit(stream(spark, path), fail, offsets, once=True).awaitTermination()
    # The failed batch is delivered again.
    sinks.for_each_edit(stream(spark, path), collect, offsets, once=True).awaitTermination()
    assert seen == [(0, 30), (1, 30)]


def test_fan_out_computes_a_batch_once(spark):
    tries = spark.sparkContext.accumulator(0)
    seen = []

    def touch(batches):
        for batch in batches:
            tries.add(len(batch))
            yield batch

    frame = spark.range(100).mapInPandas(touch, "id long")
    sinks.fan_out(frame, [lambda b, i: seen.append(b.count()), lambda b, i: seen.append(b.agg(F.max("id")).first()[0])])
    assert seen == [100, 99] and tries.value == 100


def test_flagship_job(spark):
    import __spark_entry__

    result = __spark_entry__.entry(spark)
    assert result.columns == ["bucket", "channel", "n", "cluster", "centre", "distance", "is_anomaly"]
    assert result.count() > 0
    first = result.agg(F.min("bucket")).first()[0] / 1e6
    assert datetime.datetime.fromtimestamp(first, datetime.timezone.utc).isocalendar().week == 2


def test_late_edits_are_counted_as_dropped(spark, folder):
    events = [("a", 0, "x"), ("b", 7200, "x"), ("c", 14400, "x"), ("late", 10, "x"), ("d", 21600, "x")]
    path = folder("in")
    for place, event in enumerate(events):
        frame = spark.createDataFrame([(at(event[1]), event[2])], "ts timestamp, channel string")
        frame.coalesce(1).write.parquet(f"{path}/p={place}")
    source = spark.readStream.schema("ts timestamp, channel string").option("maxFilesPerTrigger", 1)
    listener = counting.LateRows()
    spark.streams.addListener(listener)
    counted = counting.stream_counts(source.parquet(f"{path}/*"), "1 hour", "0 seconds")
    query = sinks.start(counted, lambda batch, batch_id: batch.count(), folder("offsets"), once=True)
    query.awaitTermination()
    assert counting.dropped_late(query) == 1
    for _ in range(100):  # the listener is told a little later
        if listener.dropped.get(str(query.id)):
            break
        time.sleep(0.1)
    spark.streams.removeListener(listener)
    assert listener.dropped[str(query.id)] == 1


def test_replayed_frames_count_once(spark, folder):
    from editflow.plans import jobs

    edits = edit_frame(spark, 60).withColumn("channel", F.lit("#c"))
    options = {"format": "parquet", "path": folder("bus")}
    bus.write_bus(bus.encode_bus(edits), options)
    bus.write_bus(bus.encode_bus(edits.limit(30)), options)
    metrics = folder("metrics")
    jobs.count(
        spark, options, metrics, folder("offsets"), "1 day", once=True, table=folder("edits")
    ).awaitTermination()
    got = {(r.bucket, r["name"]): r.value for r in spark.read.parquet(metrics).collect()}
    assert got == {(r.bucket, r["name"]): r.n for r in counts.count_rollup(edits, "1 day").collect()}
    # A stream of counts drops the copies that come within the watermark.
    rows = [(f"i{n}", n * 60, "#c.wikipedia") for n in range(200)]
    path, out = in_files(spark, folder, rows + rows, 4), folder("out")
    counted = counting.stream_counts(stream(spark, path), "1 hour", "10 minutes", unique=["id"])
    sinks.start(counted, sinks.batch_folder(out), folder("offsets"), once=True).awaitTermination()
    assert {r.n for r in spark.read.parquet(out).collect()} == {60}


def test_an_error_in_the_store_of_counts_stops_the_count_job(spark, folder, monkeypatch):
    from editflow.plans import jobs
    from editflow.sources.bus import encode_bus, write_bus

    bus = {"format": "parquet", "path": folder("bus")}
    write_bus(encode_bus(edit_frame(spark, 60), "json"), bus)

    def no_store(path):
        def write(batch, batch_id):
            raise OSError("storage")

        return write

    monkeypatch.setattr(jobs, "batch_folder", no_store)
    query = jobs.count(spark, bus, folder("metrics"), folder("offsets"), "1 hour", "0 seconds", once=True)
    with pytest.raises(Exception, match="storage"):
        query.awaitTermination()
