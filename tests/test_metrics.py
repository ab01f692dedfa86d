"""Metric aggregates against brute force."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from editflow.functions import skew
from editflow.operators import metrics
from tests.test_series import seconds, slot


def metric_rows(count=1500, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        name = "hot" if i % 3 == 0 else f"m{rng.randrange(4)}"
        s = 7 if rng.random() < 0.3 else rng.randrange(0, 3 * 86400)
        value = rng.randrange(0, 5000)
        text = rng.choice(["", "+", "-", "-"]) + str(value)
        rows.append((i, s, name, value, text, rng.choice([1.0, 0.5, 0.25]), rng.choice(["c", "g", "s", "ms"])))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(
        rows, "event_id long, s long, name string, value int, setting string, rate double, kind string"
    )
    return df.withColumn("ts", F.timestamp_seconds(F.col("s") + 1709251200)).drop("s")


def grouped(rows, kind, step):
    groups = defaultdict(list)
    for row in rows:
        if row[6] == kind:
            groups[slot(row[1], step), row[2]].append(row)
    return groups


def keyed(df):
    return {(seconds(r.bucket), r["name"]): r for r in df.collect()}


def test_counter_and_set(spark):
    rows = metric_rows()
    counter = keyed(metrics.metric_counter(frame(spark, rows), "1 hour"))
    for key, members in grouped(rows, "c", 3600).items():
        assert counter[key].value == pytest.approx(sum(r[3] / r[5] for r in members))
    unique = keyed(metrics.metric_set(frame(spark, rows), "1 hour"))
    for key, members in grouped(rows, "s", 3600).items():
        assert unique[key].value == len({r[3] for r in members})
    assert len(unique) == len(grouped(rows, "s", 3600))


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_gauge(spark, monkeypatch, broadcast_rows):
    if broadcast_rows == 0:
        monkeypatch.setattr(
            metrics,
            "lookup_join",
            lambda *a, **k: skew.lookup_join(*a, **k, broadcast_rows=0, parts=4),
        )
    rows = metric_rows()
    got = keyed(metrics.metric_gauge(frame(spark, rows), "1 hour", value="setting"))
    state, expected = defaultdict(float), {}
    for i, s, name, value, text, _, kind in sorted(rows, key=lambda r: (r[1], r[0])):
        if kind == "g":
            state[name] = float(text) + (state[name] if text[0] in "+-" else 0)
            expected[slot(s, 3600), name] = state[name]
    assert {k: r.value for k, r in got.items()} == expected


def test_timing_percentiles_interpolate(spark):
    rows = metric_rows()
    got = keyed(metrics.metric_timing(frame(spark, rows), "1 day", percentages=(0.0, 0.5, 0.9, 1.0)))
    expected = grouped(rows, "ms", 86400)
    assert set(got) == set(expected)
    for key, members in expected.items():
        values = sorted(r[3] for r in members)

        def at(p):
            rank = p * (len(values) - 1)
            low = int(rank)
            high = min(low + (rank > low), len(values) - 1)
            return values[low] + (values[high] - values[low]) * (rank - low)

        row = got[key]
        assert (row.samples, row.least, row.greatest) == (len(values), values[0], values[-1])
        assert row["mean"] == pytest.approx(sum(values) / len(values))
        for p in (0.0, 0.5, 0.9, 1.0):
            assert row[f"p{round(p * 100)}"] == pytest.approx(at(p))


def test_metric_lines(spark):
    df = spark.createDataFrame(
        [("a", 5, "c", 1.0), ("b", -3, "g", 2.0), ("c", 320, "ms", 0.1)],
        "name string, value int, kind string, rate double",
    )
    assert [r.line for r in metrics.metric_lines(df).collect()] == ["a:5|c", "b:-3|g", "c:320|ms|@0.1"]


def test_text_that_is_no_number_does_not_set_a_gauge(spark):
    rows = [(i, i, "m", 0, text, 1.0, "g") for i, text in enumerate(["+5", "abc", "+2"])]
    found = metrics.metric_gauge(frame(spark, rows), "1 minute", value="setting", order=["ts", "event_id"])
    assert [r.value for r in found.collect()] == [7.0]
