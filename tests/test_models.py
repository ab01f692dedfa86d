"""Training and scoring against brute force."""

import datetime
import itertools
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from editflow.functions import skew
from editflow.functions.clusters import best_clusters
from editflow.operators import counts, joins, models
from editflow.schema import MODEL
from editflow.session import checkpoint_root


def counts_frame(spark, rows):
    df = spark.createDataFrame(rows, "channel string, s long, n long")
    return df.select("channel", F.timestamp_seconds("s").alias("bucket"), "n")


MODELS = [
    ("a", 2023, 52, 0, 100.0), ("a", 2024, 1, 0, 5.0), ("a", 2024, 1, 1, 10.0), ("a", 2024, 1, 2, 15.0),
    ("b", 2024, 1, 0, 0.0),
]


def test_nearest_centre_and_ties(spark):
    trained = spark.createDataFrame(MODELS, MODEL)
    rows = [("a", 1, 7), ("a", 2, 8), ("a", 3, 1000), ("b", 4, 3), ("c", 5, 1)]
    got = {r.n: r for r in joins.nearest_centroid(counts_frame(spark, rows), trained).collect()}
    assert (got[7].centre, got[7].distance, got[8].centre) == (5.0, 2.0, 10.0)
    assert (got[1000].cluster, got[3].cluster) == (2, 0)
    # A channel without a model is not scored; the newest year and week are the model.
    assert set(got) == {7, 8, 1000, 3}
    tie = spark.createDataFrame([("a", 2024, 51, 1, 5.0), ("a", 2024, 51, 0, 9.0)], MODEL)
    assert joins.nearest_centroid(counts_frame(spark, [("a", 1, 7)]), tie).first().cluster == 0


def test_anomaly_rule_is_strict(spark):
    trained = spark.createDataFrame([("a", 2024, 1, 0, 10.0), ("a", 2024, 1, 1, 100.0), ("b", 2024, 1, 0, 0.0)], MODEL)
    rows = [("a", 1, 11), ("a", 2, 12), ("a", 3, 9), ("a", 4, 8), ("a", 5, 105), ("a", 6, 0), ("b", 7, 0), ("b", 8, 1)]
    scored = models.detect_anomalies(counts_frame(spark, rows), trained, eps=0.1)
    found = {(r.channel, r.n): r.is_anomaly for r in scored.collect()}
    assert found == {
        ("a", 11): False, ("a", 12): True, ("a", 9): False, ("a", 8): True, ("a", 105): False,
        ("a", 0): True, ("b", 0): False, ("b", 1): True,
    }
    named = {r["name"]: r.n for r in counts.anomaly_counts(scored, "1 day").collect()}
    assert named == {"a-anomaly": 3, "b-anomaly": 1}
    score = {r.channel: r.score for r in models.clustering_score(counts_frame(spark, rows), trained).collect()}
    assert score["a"] == pytest.approx((1 + 2 + 1 + 2 + 5 + 10) / 6)


def cells(spark, seed=2):
    """Edits whose counts per hour of the week are known."""
    rng = random.Random(seed)
    rows, histogram = [], {}
    for channel in ("a", "b", "c"):
        values = [rng.choice([1, 2, 3, 10, 11, 30]) if channel != "c" else 4 for _ in range(60)]
        histogram[channel] = Counter(values)
        for cell, n in enumerate(values):
            rows += [(channel, 2024, 2, 7, 1 + cell // 24, cell % 24)] * n
    rows += [("a", 2024, 2, 8, 1, 1)] * 50 + [("a", 2023, 2, 7, 1, 1)] * 90
    schema = "channel string, year int, month int, week int, weekday int, hour int"
    return spark.createDataFrame(rows, schema), histogram


def lloyd(histogram, k, iterations):
    values = sorted(histogram)
    centres = list(dict.fromkeys(float(values[j * (len(values) - 1) // max(k - 1, 1)]) for j in range(k)))
    for _ in range(iterations):
        sums, sizes = Counter(), Counter()
        for v, w in histogram.items():
            nearest = min(range(len(centres)), key=lambda i: (abs(v - centres[i]), i))
            sums[nearest] += v * w
            sizes[nearest] += w
        centres = [sums[i] / sizes[i] if sizes[i] else c for i, c in enumerate(centres)]
    return centres


@pytest.mark.parametrize(("k", "iterations"), [(1, 3), (3, 0), (3, 4), (55, 5)])
def test_models_step_by_step(spark, k, iterations):
    edits, histogram = cells(spark)
    trained = models.fit_models_stepwise(edits, 7, k, iterations, grain="hour")
    got = {}
    for r in trained.orderBy("channel", "cluster").collect():
        got.setdefault(r.channel, []).append(r.centre)
    assert set(got) == set(histogram)
    for channel, counted in histogram.items():
        assert got[channel] == pytest.approx(lloyd(counted, k, iterations))
    assert trained.schema.fieldNames() == MODEL.fieldNames()


def test_one_channel_model(spark):
    edits, histogram = cells(spark)
    trained = models.fit_channel_model(edits.withColumn("channel", F.lit("a")).where("week = 7"), "a", 7, 3, "hour")
    assert trained.count() == 3
    few = models.fit_channel_model(edits, "c", 7, grain="hour", year=2024)
    assert [r.centre for r in few.collect()] == [4.0]
    weekly = counts.weekly_minute_counts(edits, "b", 7, grain="hour", year=2024)
    assert Counter(r.n for r in weekly.collect()) == histogram["b"]
    score = models.clustering_score(weekly, k=len(histogram["b"])).first().score
    assert score == pytest.approx(0.0)
    vectors = counts.count_vectors(weekly, as_vector=True)
    assert vectors.first().features.size == 1


def cost(histogram, centres):
    return sum(w * min((v - c) ** 2 for c in centres) for v, w in histogram.items())


def splits(histogram, k):
    """The least cost of all ways to cut the sorted values into k runs."""
    values = sorted(histogram)
    costs = []
    for cuts in itertools.combinations(range(1, len(values)), min(k, len(values)) - 1):
        edges = [0, *cuts, len(values)]
        total = 0.0
        for a, b in zip(edges, edges[1:]):
            part = {v: histogram[v] for v in values[a:b]}
            mean = sum(v * w for v, w in part.items()) / sum(part.values())
            total += cost(part, [mean])
        costs.append(total)
    return min(costs)


def test_best_clusters_against_all_splits():
    rng = random.Random(4)
    for _ in range(300):
        histogram = {v: rng.randrange(1, 9) for v in rng.sample(range(60), rng.randrange(1, 9))}
        k = rng.randrange(1, 6)
        found = best_clusters(np.array(list(histogram)), np.array(list(histogram.values())), k)
        assert found == sorted(found) and len(found) == min(k, len(histogram))
        assert cost(histogram, found) == pytest.approx(splits(histogram, k), abs=1e-6)
    assert best_clusters(np.array([], int), np.array([], int), 3) == []


@pytest.mark.parametrize("k", [1, 2, 3, 4, 55])
def test_best_models_of_all_channels(spark, k):
    """Never dearer than Lloyd's, and the newest year with the week alone counts."""
    edits, histogram = cells(spark)
    got = {}
    for r in models.fit_all_models(edits, 7, k, "hour").orderBy("channel", "cluster").collect():
        assert (r.year, r.week) == (2024, 7)
        got.setdefault(r.channel, []).append(r.centre)
    assert set(got) == set(histogram)
    for channel, counted in histogram.items():
        assert cost(counted, got[channel]) == pytest.approx(splits(counted, k), abs=1e-6)
        assert cost(counted, got[channel]) <= cost(counted, lloyd(counted, k, 30)) + 1e-9
    old = models.fit_channel_model(edits, "a", 7, k, "hour", year=2023)
    assert [(r.year, r.centre) for r in old.collect()] == [(2023, 90.0)]
    assert models.fit_all_models(edits.limit(0), 7, k, "hour").collect() == []


def test_stepwise_models_leave_no_scratch_tables_behind(spark):
    root = checkpoint_root(spark).removeprefix("file:")
    before = {n for n in os.listdir(root) if "step" in n}
    edits, _ = cells(spark)
    assert models.fit_models_stepwise(edits, 7, 3, 20, grain="hour").count() > 0
    assert {n for n in os.listdir(root) if "step" in n} == before


def monday(year, week):
    return datetime.datetime.fromisocalendar(year, week, 1).replace(tzinfo=datetime.timezone.utc)


def test_models_as_of_the_time_of_a_count(spark):
    """Against a loop, across New Year, with a hot channel and counts at the very moment."""
    rng = random.Random(9)
    versions = [(c, y, w) for c in "abc" for y, w in [(2023, 51), (2023, 52), (2024, 1), (2024, 5)] if (c, w) != ("b", 52)]
    trained = spark.createDataFrame([(c, y, w, 0, float(y * 100 + w)) for c, y, w in versions], MODEL)
    begin = monday(2023, 50)
    rows = [(rng.choice("aaaaabcd"), int(begin.timestamp()) + rng.randrange(0, 80 * 86400, 3600), i) for i in range(600)]
    rows += [("a", int(monday(2024, 1).timestamp()), 600), ("a", int(monday(2024, 2).timestamp()) - 1, 601), (None, 0, 602)]
    found = joins.attach_model(counts_frame(spark, rows).repartition(6), trained, when="before").collect()
    expected = {}
    for channel, second, n in rows:
        over = [(y, w) for c, y, w in versions if c == channel and monday(y, w).timestamp() + 7 * 86400 <= second]
        if over:
            expected[n] = max(over)
    assert {r.n: (r.model_year, r.model_week) for r in found} == expected
    assert all(r.centres[0].centre == r.model_year * 100 + r.model_week for r in found)


def test_a_hot_channel_is_dealt_over_the_tasks_of_the_sort(spark):
    from editflow.functions.skew import as_of

    rows = spark.range(40_000).select(F.lit("hot").alias("k"), F.col("id").alias("at"))
    versions = spark.range(0, 40_000, 1_000).select(F.lit("hot").alias("k"), F.col("id").alias("since"), F.col("id").alias("v"))
    found = as_of(rows, versions, ["k"], "at", "since", ["v"])
    assert found.where("v <> at - at % 1000").count() == 0 and found.count() == 40_000
    placed = skew.placed(rows, ["at"], ["k"]).groupBy("_part").count().collect()
    assert len(placed) >= 4 and max(r["count"] for r in placed) <= 10_500
