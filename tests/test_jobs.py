"""The jobs one after the other, over a bus of Parquet files."""

import json
from collections import Counter

from pyspark.sql import functions as F

from editflow.operators import counts, series
from editflow.plans import jobs
from editflow.schema import EDIT_COLUMNS
from editflow.sources.edits import read_edits
from editflow.sources.lines import write_json_lines
from editflow.sources.models import load_models
from tests.data import edit_frame


def test_lines_to_anomalies(spark, folder):
    landing, table, model_path = folder("landing"), folder("edits"), folder("models")
    metrics, scored = folder("metrics"), folder("scored")
    bus = {"format": "parquet", "path": folder("bus")}
    channel = F.when(F.col("is_robot"), "#en.wikipedia").otherwise("#de.wikipedia")
    edits = edit_frame(spark, 300).withColumn("channel", channel)
    write_json_lines(edits, landing)
    spark.createDataFrame([("no json",)], "value string").write.mode("append").text(landing)

    jobs.ingest(spark, landing, bus, folder("offsets"), once=True).awaitTermination()
    totals = folder("totals")
    jobs.store(spark, bus, table, folder("offsets"), once=True, totals=totals).awaitTermination()
    assert [(r["name"], r.value) for r in spark.read.parquet(totals).collect()] == [("inserted", 300)]
    stored = read_edits(spark, table)
    without_id = [c for c in EDIT_COLUMNS if c != "id"]
    assert sorted(stored.select(*without_id).collect()) == sorted(edits.select(*without_id).collect())

    jobs.count(spark, bus, metrics, folder("offsets"), "1 day", "10 seconds", once=True).awaitTermination()
    rows = spark.read.parquet(metrics).collect()
    newest = edits.agg(F.max("ts")).first()[0]
    per_day = counts.count_by_channel(edits, "1 day")
    both = per_day.selectExpr("bucket", "channel as name", "n").unionByName(counts.count_all(edits, "1 day"))
    filled = series.zero_fill(both, "1 day", ["name"]).collect()
    expected = {(r.bucket, r["name"]): r.n for r in filled if (newest - r.bucket).total_seconds() >= 86410}
    assert {(r.bucket, r["name"]): r.value for r in rows} == expected
    assert rows[0].line == f"{rows[0]['name']}:{rows[0].value}|c"

    week = stored.first().week
    jobs.train(spark, table, model_path, week, k=3, grain="hour")
    jobs.train(spark, table, model_path, week, channel="#de.wikipedia", year=2024, k=2, grain="hour")
    trained = load_models(spark, model_path)
    assert {r.channel for r in trained.collect()} == {"#de.wikipedia", "#en.wikipedia"}
    jobs.score(spark, bus, model_path, scored, folder("offsets"), "1 day", "10 seconds", once=True).awaitTermination()
    found = spark.read.parquet(f"{scored}/scored")
    assert found.where("is_anomaly").count() > 0
    unusual = {(r.bucket, f"{r.channel}-anomaly"): int(r.is_anomaly) for r in found.collect()}
    counters = spark.read.parquet(f"{scored}/anomalies").collect()
    assert {(r.bucket, r["name"]): r.value for r in counters} == unusual

    sent = folder("sent")
    subscriptions = spark.createDataFrame([("a", "#de.wikipedia"), ("b", "#all.wikipedia")], "subscriber string, channel string")

    def send(batch, batch_id):
        batch.write.mode("append").parquet(sent)

    jobs.feed(spark, bus, subscriptions, send, folder("offsets"), once=True).awaitTermination()
    got = Counter((r.subscriber, json.loads(r.line)["channel"]) for r in spark.read.parquet(sent).collect())
    per_channel = Counter(r.channel for r in edits.select("channel").collect())
    assert got == {
        ("a", "#de.wikipedia"): per_channel["#de.wikipedia"],
        ("b", "#de.wikipedia"): per_channel["#de.wikipedia"],
        ("b", "#en.wikipedia"): per_channel["#en.wikipedia"],
    }


def test_scoring_knows_the_year_of_the_week(spark):
    from tests.data import irc_line

    days = {"2023-12-20": 9, "2024-01-01": 2, "2024-01-03": 2, "2024-01-09": 2, "2025-01-01": 9}
    rows = [
        (f"{day} 10:{i:02d}:00", "#c", irc_line(f"p{i}", "", "(+1)")) for day, n in days.items() for i in range(n)
    ]
    lines = spark.createDataFrame(rows, "t string, channel string, raw string")
    lines = lines.select(F.to_timestamp("t").alias("ts"), "channel", "raw")
    found = jobs.train_and_score(lines, 1, 1, year=2024, interval="1 day")
    got = {str(r.bucket)[:10]: r.n for r in found.where("n > 0").collect()}
    assert got == {"2024-01-09": 2, "2025-01-01": 9}
