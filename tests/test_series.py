"""Count series against brute force."""

import datetime
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from editflow.functions.intervals import interval_micros
from editflow.operators import counts, filters, series
from editflow.schema import STORED_KEY
from tests.data import edit_frame, skewed_events
from tests.test_skew import events

EPOCH = datetime.datetime(2024, 3, 1)


def slot(s, step):
    return s // step * step


def seconds(ts):
    return int((ts - EPOCH).total_seconds())


def test_intervals():
    assert interval_micros("10 seconds") == 10_000_000
    assert interval_micros("1 minute") == 60_000_000
    assert interval_micros("2 hours") == 7_200_000_000


def test_counts(spark):
    rows = skewed_events(2000)
    frame = events(spark, rows)
    per_channel = Counter((slot(s, 60), c) for _, s, c in rows)
    total = Counter(slot(s, 60) for _, s, _ in rows)
    got = {(seconds(r.bucket), r.channel): r.n for r in counts.count_by_channel(frame, "60 seconds").collect()}
    assert got == per_channel
    assert {seconds(r.bucket): r.n for r in counts.count_all(frame, "60 seconds").collect()} == total
    rollup = {(seconds(r.bucket), r.name): r.n for r in counts.count_rollup(frame, "60 seconds").collect()}
    assert rollup == {**per_channel, **{(b, "all-messages"): n for b, n in total.items()}}
    inserted = counts.inserted_total(frame, "60 seconds").collect()
    so_far = 0
    for r in sorted(inserted, key=lambda r: r.bucket):
        so_far += r.n
        assert r.inserted == so_far
    matching = counts.count_matching(frame, "hot", F.col("channel") == "#en.wikipedia", "60 seconds", 3)
    assert {seconds(r.bucket): r.n for r in matching.collect()} == {
        b: per_channel.get((b, "#en.wikipedia"), 0) + 3 for b in range(min(total), max(total) + 1, 60)
    }


@pytest.mark.parametrize("block", [7, 10_000])
def test_zero_fill(spark, monkeypatch, block):
    monkeypatch.setattr(series, "FILL_BLOCK", block)
    rows = skewed_events(300)
    counted = counts.count_by_channel(events(spark, rows), "1 hour")
    filled = series.zero_fill(counted, "1 hour").collect()
    known = Counter((slot(s, 3600), c) for _, s, c in rows)
    last = max(b for b, _ in known)
    expected = {}
    for channel in {c for _, c in known}:
        first = min(b for b, c in known if c == channel)
        for b in range(first, last + 1, 3600):
            expected[b, channel] = known.get((b, channel), 0)
    assert {(seconds(r.bucket), r.channel): r.n for r in filled} == expected
    assert len(filled) == len(expected)


@pytest.mark.parametrize(("n", "include_current"), [(10, True), (10, False), (1, True), (3, True)])
def test_moving_average_looks_back_over_sparse_days(spark, n, include_current):
    rng = random.Random(9)
    # Days with many points, days with one point, and gaps of many days.
    points = defaultdict(dict)
    for channel in ("a", "b"):
        for day in (0, 1, 2, 3, 9, 10, 30, 31, 32, 33, 34, 60):
            for _ in range(rng.choice([1, 1, 2, 40])):
                points[channel][day * 86400 + rng.randrange(0, 1440) * 60] = rng.randrange(0, 100)
    rows = [(c, s, v) for c, series_ in points.items() for s, v in series_.items()]
    frame = spark.createDataFrame(rows, "channel string, s long, n long")
    frame = frame.select("channel", F.timestamp_seconds(F.col("s") + 1709251200).alias("bucket"), "n")
    got = {
        (r.channel, seconds(r.bucket)): r.average
        for r in series.moving_average(frame, n, include_current).collect()
    }
    assert len(got) == len(rows)
    for channel, series_ in points.items():
        ordered = sorted(series_)
        for i, s in enumerate(ordered):
            seen = ordered[max(0, i - n + 1) : i + 1] if include_current else ordered[max(0, i - n) : i]
            values = [series_[x] for x in seen]
            if values:
                assert got[channel, s] == pytest.approx(sum(values) / len(values))
            else:
                assert got[channel, s] is None


def test_recent_window(spark):
    rows = skewed_events(400)
    frame = events(spark, rows)
    newest = max(s for _, s, _ in rows)
    assert filters.recent_window(frame, "1 day").count() == sum(s >= newest - 86400 for _, s, _ in rows)
    now = EPOCH + datetime.timedelta(days=2)
    kept = filters.recent_window(frame, "1 day", now=now).count()
    assert kept == sum(s >= 86400 for _, s, _ in rows)


def test_channel_and_week_filters(spark):
    from editflow.operators.parse import calendar_fields

    edits = calendar_fields(edit_frame(spark, 300)).withColumn("channel", F.lit("#De.wikipedia"))
    assert filters.filter_channel(edits, "#ALL.wikipedia").count() == 300
    # The wanted name is lower-cased, the edit's is not.
    assert filters.filter_channel(edits, "#De.wikipedia").count() == 0
    week = edits.first().week
    assert filters.filter_week(edits, week, 2023).count() == 0
    assert 0 < filters.filter_week(edits, week).count() == filters.filter_week(edits, week, 2024).count()


def test_sample_metrics(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "event_id")
    assert filters.sample_metrics(rows, 1.0).count() == 20_000
    kept = filters.sample_metrics(rows, 0.25, seed=7)
    assert 4500 < kept.count() < 5500
    assert [r.rate for r in kept.select("rate").distinct().collect()] == [0.25]
    again = filters.sample_metrics(rows.repartition(7), 0.25, seed=7)
    assert sorted(kept.collect()) == sorted(again.collect())
    assert sorted(kept.collect()) != sorted(filters.sample_metrics(rows, 0.25, seed=8).collect())


def test_clustering_order(spark):
    from editflow.operators.parse import calendar_fields

    edits = calendar_fields(edit_frame(spark, 500))
    rows = series.clustering_order(edits).select(*STORED_KEY).collect()
    assert rows == sorted(rows)


def test_series_of_counters_are_filled_and_smoothed(spark):
    rows = [("2023-12-31 22:00:00", "all-messages", 3), ("2024-01-01 01:00:00", "all-messages", 5)]
    frame = spark.createDataFrame(rows, "t string, name string, n long").select(F.to_timestamp("t").alias("bucket"), "name", "n")
    filled = series.zero_fill(frame, "1 hour", keys=["name"], empty=2)
    assert [r.n for r in filled.orderBy("bucket").collect()] == [3, 2, 2, 5]
    smooth = series.moving_average(filled, 2, keys=["name"]).orderBy("bucket").collect()
    assert [r.average for r in smooth] == [3, 2.5, 2, 3.5]


def test_fill_before_1970(spark):
    rows = [("1969-12-31 22:00:00", "#c", 1), ("1970-01-01 01:00:00", "#c", 1)]
    frame = spark.createDataFrame(rows, "t string, channel string, n long").select(F.to_timestamp("t").alias("bucket"), "channel", "n")
    filled = series.zero_fill(frame, "1 hour").orderBy("bucket").collect()
    assert [(r.bucket.hour, r.n) for r in filled] == [(22, 1), (23, 0), (0, 0), (1, 1)]
