"""Nulls, empty tables, repeated rows, very long texts and clashing columns."""

import pytest
from pyspark.sql import functions as F

from editflow.llm import decontam, embeddings, licences, minhash, mixing, perplexity, suffix, toolcalls, toxicity, warc

LONG = "word " * 60_000 + "x" * 100_000
ROWS = [
    (1, "some text with a few more words in it", "en", "s"), (1, "some text with a few more words in it", "en", "s"),
    (2, None, None, None), (3, "", "en", "s"), (None, "some text with a few more words in it", "de", None),
    (4, LONG, "en", "t"), (5, "Some TEXT with a few more words in it", "en", None), (5, "another text", "en", "s"),
]
DOCS = "doc_id long, text string, lang string, source string"
LABELS = "doc_id long, quality int, toxic int"
CLASHES = ["kept", "score", "predicted", "size", "target", "component", "licences", "threshold", "n_bytes", "copies", "key"]


def labels(spark, empty):
    rows = [(1, 1, 0), (4, 1, 1), (None, 1, 1), (5, None, None), (3, 0, 1)]
    return spark.createDataFrame([] if empty else rows, LABELS)


OPERATORS = {
    "near_copies": lambda s, d, e: minhash.near_copies(d),
    "without_repeats": lambda s, d, e: suffix.without_repeats(d),
    "mixed": lambda s, d, e: mixing.mixed(d),
    "licences": lambda s, d, e: licences.licences(d),
    "quality": lambda s, d, e: perplexity.quality(d, labels(s, e)),
    "toxicity": lambda s, d, e: toxicity.toxicity(d, labels(s, e)),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_documents(spark, name):
    empty = spark.createDataFrame([], DOCS)
    assert OPERATORS[name](spark, empty, True).count() == 0
    docs = spark.createDataFrame(ROWS, DOCS).withColumns({c: F.lit("mine") for c in CLASHES})
    found = OPERATORS[name](spark, docs, False).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in ROWS)


def test_near_copies_of_repeated_and_unnamed_rows(spark):
    found = minhash.near_copies(spark.createDataFrame(ROWS, DOCS)).collect()
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in found}
    assert got[1, 5] == (1, True) and got[5, 5] == (1, False) and got[None, 5] == (None, True)
    assert got[2, 0] == (2, True) and got[3, 0] == (3, True)


def test_benchmark_items(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    items = spark.createDataFrame(
        [(1, "text with a few more words"), (2, None), (3, ""), (None, "a few more words in it"), (4, "another text")],
        "item_id long, text string",
    )
    found = decontam.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} >= {(1, 1), (None, 1), (5, 1), (1, None)}
    assert not {r.doc_id for r in found} & {2, 3}
    assert decontam.contaminated(docs, items.limit(0)).count() == 0
    assert decontam.contaminated(docs.limit(0), items).count() == 0


def test_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]),
        (7, [None, 1.0]), (8, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (9, [1.0, float("inf")]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("kept", F.lit(1))
    found = embeddings.near_vectors(frame).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    assert len(found) == len(rows) and got[None] == (0, None, True)
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False)
    assert all(got[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9))
    assert embeddings.near_vectors(frame.limit(0)).count() == 0


def test_pages(spark):
    rows = [(1, None, None), (None, "u", "x" * 200), (None, "u", "x" * 200), (3, "u", LONG), (4, "u", LONG), (3, "u", LONG)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("mine"))
    found = warc.archived(frame).collect()
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in found)
    assert got == [
        ("1", "response", "None"), ("3", "response", "None"), ("3", "response", "None"), ("4", "revisit", "3"),
        ("None", "response", "None"), ("None", "response", "None"),
    ]
    assert warc.archived(frame.limit(0)).count() == 0


def test_conversations(spark):
    rows = [(1, 0, "user", "hello"), (1, 0, "user", "hello"), (1, 1, "assistant", None), (None, 0, "user", "x"), (2, None, "user", "x"), (3, 0, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("level", F.lit(9))
    found = toolcalls.linked_calls(toolcalls.as_messages(turns)).collect()
    assert sorted((r.conv_id, r.turn, r.level, r.valid) for r in found) == [(1, 0, 0, True), (3, 0, 0, False)]
    assert toolcalls.linked_calls(toolcalls.as_messages(turns.limit(0))).count() == 0


def test_pipeline_stages(spark, folder):
    import corpus_pipeline

    path = folder("tables")
    spark.createDataFrame(ROWS, DOCS).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{path}/documents.parquet")
    labels(spark, False).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "no such passage in any of them")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, path), "stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert {r.doc_id for r in docs.collect()} <= {1, 2, 3, 4, 5, None}
    assert corpus_pipeline.run(spark, path).count() == docs.count()


def test_pipeline_drops_near_copies_from_80_percent(spark):
    import corpus_pipeline

    rows = []
    for i in range(60):
        base = [f"w{i}x{j}" for j in range(104)]
        # One word replaced takes 5 of 100 shingles of each: 95 of 105, 90 of 110, 85 of 115 are common.
        for place, changed in enumerate([(), (20, 60), (20, 40, 60)]):
            text = " ".join("new" if j in changed else w for j, w in enumerate(base))
            rows.append((10 * i + place, text if place != 2 or i % 2 else " ".join(base[:50]), "en", "s"))
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_chars", F.length("text").cast("long"))
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert {10 * i for i in range(60)} <= kept
    assert not {10 * i + 1 for i in range(60)} & kept
    # The half of a text has 46 of 100 shingles and stays.
    assert {10 * i + 2 for i in range(0, 60, 2)} <= kept


def test_mix_keeps_the_texts_of_unnamed_rows(spark):
    import corpus_pipeline

    rows = [(None, f"word {i} " * (3 + i), "en", "s") for i in range(6)] * 2 + [(i, f"other {i} " * 4, "en", "t") for i in range(6)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_chars", F.length("text").cast("long"))
    found = corpus_pipeline.mix(spark, docs, "").collect()
    assert all(r.size == len(r.text.split()) for r in found) and len(found) <= len(rows)
    # The target is 1.5 times all words, so at least half of the unnamed rows are taken.
    assert sum(r.doc_id is None for r in found) >= 6


def test_long_passages_and_clashing_columns_of_benchmark_items(spark):
    """An item of 9,000 words in a text of 60,000; columns named as the results; items that share an id."""
    item = " ".join(f"w{i}" for i in range(9_000))
    docs = spark.createDataFrame([(1, LONG + " " + item + " " + LONG), (2, LONG)], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("mine") for c in ("item_id", "score", "question", "answer", "overlap")})
    items = spark.createDataFrame([(7, item), (7, "another short item of some words")], "item_id long, text string")
    items = items.withColumns({c: F.lit("mine") for c in ("doc_id", "shard", "units")})
    found = decontam.contaminated(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.overlap) for r in found] == [(1, 7, 1.0)]


def test_pages_with_any_signs(spark):
    """Signs beyond the basic plane, zero bytes and a page of a megabyte come back as they were."""
    pages = ["\U0001f600" * 100, "a\x00b" * 100, "x" * 1_000_000, "\ud7ff\ue000" * 60, "\r\n\r\nWARC/1.1\r\n" * 20]
    frame = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").withColumn("url", F.lit("u\r\nX: 1"))
    found = {r.page_id: bytes(r.payload).decode() for r in warc.archived(frame).collect()}
    assert found == dict(enumerate(pages))


def test_vectors_at_the_threshold(spark):
    """Links are those that double precision gives, on both sides of 0.9 and at it."""
    import numpy as np

    rng = np.random.default_rng(1)
    rows = [(0, [1.0, 0.0, 0.0, 0.0]), (1, [9.0, 3.0, 3.0, 1.0]), (2, [9.0, 3.0, 3.0, 1.001]), (3, [9.0, 3.0, 3.0, 0.999])]
    for i in range(4, 40):
        along, across = float(rng.choice([0.8999, 0.9, 0.9001])), rng.normal(size=3)
        across *= np.sqrt(1 - along**2) / np.linalg.norm(across)
        rows.append((i, [along, *across.tolist()]))
    unit = np.array([v for _, v in rows])
    unit = unit / np.abs(unit).max(1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = unit @ unit.T >= 0.9
    found = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    near = {r.vec_id: r.n_links for r in found}
    # Products that differ from 0.9 by rounding alone may fall on either side.
    unsure = (np.abs(unit @ unit.T - 0.9) < 1e-12).sum(1)
    assert all(abs(near[i] - (links[i].sum() - 1)) <= unsure[i] for i in near)
    assert near[0] >= 12


def test_rates_of_the_mix_are_tilted_alike(spark):
    """Entropy balancing: in a source the odds of a word are one exponential of the size, whatever the sizes."""
    import math

    rows = [(i, "w " * (1 + i % 17), "s") for i in range(300)] + [(1_000 + i, "w " * (5 + i % 3), "t") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mixed(docs).collect()
    for source in "st":
        rates = {r.size: r.rate for r in found if r.source == source and 0 < r.rate < 2}
        odds = sorted((n, math.log(rate / (2 - rate))) for n, rate in rates.items())
        slopes = [(b - a) / (m - n) for (n, a), (m, b) in zip(odds, odds[1:])]
        assert len(odds) > 2 and max(slopes) - min(slopes) < 1e-3
        expected = sum(r.rate * r.size for r in found if r.source == source)
        target = next(r.target for r in found if r.source == source)
        assert abs(expected - target) < 0.01 * target
