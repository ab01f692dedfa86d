"""Numbering, running values and lookups against brute force, on skewed rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from editflow.functions.skew import lookup_join, numbered, placed, running
from editflow.operators import filters, series
from editflow.operators.joins import route_edits
from tests.data import at, skewed_events


def events(spark, rows):
    frame = spark.createDataFrame(rows, "id string, s long, channel string")
    return frame.select("id", F.timestamp_seconds(F.col("s") + 1709251200).alias("ts"), "channel")


@pytest.mark.parametrize("keys", [[], ["channel"]])
def test_numbered_is_row_number(spark, keys):
    rows = skewed_events(3000)
    result = numbered(events(spark, rows), ["ts", "id"], "rn", keys).collect()
    groups = defaultdict(list)
    for r in result:
        groups[r.channel if keys else None].append((r.rn, r.ts, r.id))
    assert len(result) == len(rows)
    for members in groups.values():
        members.sort()
        assert [m[0] for m in members] == list(range(1, len(members) + 1))
        assert [m[1:] for m in members] == sorted(m[1:] for m in members)


def test_numbered_spreads_copies_over_partitions(spark):
    copies = spark.range(0, 4000, 1, 8).select(F.lit("x").alias("id"), F.lit(0).alias("ts"))
    result = numbered(copies, ["ts", "id"], "rn")
    assert sorted(r.rn for r in result.collect()) == list(range(1, 4001))
    # Small partitions are merged at run time; without that the copies lie apart.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = [r["count"] for r in placed(copies, ["ts", "id"]).groupBy("_part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(held) > 2 and max(held) < 2000


def test_every_nth(spark):
    rows = skewed_events(500)
    shown = filters.every_nth(events(spark, rows), 50).collect()
    ordered = sorted((s, i) for i, s, _ in rows)
    assert sorted(r.position for r in shown) == list(range(0, 500, 50))
    for r in shown:
        assert ordered[r.position][1] == r.id


def test_running_sum_and_maximum(spark):
    rng = random.Random(5)
    rows = [("k" if i % 3 else f"k{i % 7}", i // 10, i, rng.randrange(-50, 50)) for i in range(400)]
    frame = spark.createDataFrame(rows, "k string, block long, i long, v long")
    sums = {(r.k, r.i): r.out for r in running(frame, ["k"], "block", "i", "v", "out").collect()}
    tops = {(r.k, r.i): r.out for r in running(frame, ["k"], "block", "i", "v", "out", F.max).collect()}
    for k, _, i, _ in rows:
        seen = [v for k2, _, i2, v in rows if k2 == k and i2 <= i]
        assert sums[k, i] == sum(seen)
        assert tops[k, i] == max(seen)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_is_the_same_salted(spark, how):
    rows = events(spark, skewed_events(600))
    lookup = spark.createDataFrame([("#en.wikipedia", 1), ("#c1.wikipedia", 2), ("#x", 3)], "channel string, v int")
    small = lookup_join(rows, lookup, ["channel"], ["id"], how).collect()
    salted = lookup_join(rows, lookup, ["channel"], ["id"], how, broadcast_rows=1, parts=5)
    assert sorted(map(tuple, small), key=repr) == sorted(map(tuple, salted.collect()), key=repr)
    # The rows of the hot channel are spread by the salt.
    assert "_salt" not in salted.columns


def test_route_edits(spark):
    rows = skewed_events(300) + [("own", 5, "#all.wikipedia")]
    subscriptions = [("a", "#EN.wikipedia"), ("b", "#all.wikipedia"), ("c", "#none.wikipedia"), ("d", "#c1.wikipedia")]
    expected = sorted(
        (name, i, channel)
        for i, _, channel in rows
        for name, wanted in subscriptions
        if wanted.lower() in (channel, "#all.wikipedia")
    )
    frame = spark.createDataFrame(subscriptions, "subscriber string, channel string")
    routed = route_edits(events(spark, rows), frame).select("subscriber", "id", "channel")
    assert sorted(map(tuple, routed.collect())) == expected


def test_latest_n_limits_before_the_shuffle(spark):
    rows = [(f"id{n}", s, c) for n, (_, s, c) in enumerate(skewed_events(900))]
    latest = series.latest_n(events(spark, rows), 8)
    by_channel = defaultdict(list)
    for i, s, c in rows:
        by_channel[c].append((at(s).replace(tzinfo=None), i))
    expected = sorted((c, i) for c, m in by_channel.items() for _, i in sorted(m, reverse=True)[:8])
    assert sorted((r.channel, r.id) for r in latest.collect()) == expected
    plan = latest._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and ", 8, Partial" in plan
