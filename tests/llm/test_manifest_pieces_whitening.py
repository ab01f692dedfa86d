"""Manifest, piece encoding and whitening against plain code, with nulls, ties, repeats and clashes."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from checks import compare
from editflow.llm import merkle, pieces, queries, whitening

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, source string, lang string, n_chars long, text string"
LONG = "Word " * 50_000 + "x" * 60_000


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, low=False):
    doc_id, source, lang, n_chars, text = row
    if low and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return digest(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(digests):
    """Root, and for each leaf the siblings left and right of its way up."""
    paths = [[] for _ in digests]
    owners = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, groups = [], []
        for at in range(0, len(digests), 16):
            run = digests[at : at + 16]
            for k in range(len(run)):
                for leaf in owners[at + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(digest(*run))
            groups.append([x for o in owners[at : at + 16] for x in o])
        digests, owners = above, groups
    return digests[0], paths


def by_hand(rows):
    order = lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))
    names = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    sources = [sorted((r for r in rows if r[1] == name), key=order) for name in names]
    grown = [tree([leaf_of(r) for r in held]) for held in sources]
    root, tops = tree([subroot for subroot, _ in grown])
    out = []
    for held, (subroot, paths), top in zip(sources, grown, tops):
        for row, path in zip(held, paths):
            chosen = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf_of(row, chosen)
            for left, right in path + top:
                node = digest(left, node, right)
            proof = digest(*(left + right for left, right in path + top))
            out.append((row[0], leaf_of(row), subroot, root, proof, node, node == root))
    return out


def documents(seed, sizes):
    draw = random.Random(seed)
    rows = []
    for place, (source, size) in enumerate(sizes):
        for i in range(size):
            text = draw.choice(["Ein Text", "all in lower case", "ÄÖ grüße", "", None, f"Text {i}"])
            rows.append((place * 10_000 + i, source, draw.choice(["en", None]), draw.choice([3, None]), text))
    return rows


@pytest.mark.parametrize(
    "rows",
    [
        documents(1, [("b", 16), ("a", 17), (None, 1), ("", 2), ("ß", 257), ("z", 33)]),
        documents(2, [(f"s{i}", 1 + i % 3) for i in range(40)]),
        documents(3, [("only", 1)]),
        documents(4, [("only", 300)]),
        [(None, "s", None, None, "A"), (None, "s", None, None, None), (7, "s", "x", 1, "A"), (7, "s", "x", 1, "A"),
         (7, "s", "x", 1, "B"), (7, None, "x", 1, "B"), (8, "s", "x", -1, LONG), (10, None, None, None, LONG)],
    ],
)
def test_manifest(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    found = merkle.trial(docs.withColumns({c: F.lit("mine") for c in ("tree", "lo", "digest", "leaf", "level")}))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(by_hand(rows), key=str)


def test_manifest_without_rows(spark):
    assert merkle.trial(spark.createDataFrame([], DOCS)).collect() == []


def test_manifest_against_sql(spark, tmp_path):
    rows = documents(5, [("b", 18), (None, 3), ("", 2), ("ß", 270)] + [(f"s{i}", 1) for i in range(20)])
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    connection = compare.duckdb.connect()
    path = tmp_path / "documents.parquet" / "*.parquet"
    connection.execute(f"create view documents as select * from read_parquet('{path}')")
    result = connection.execute(queries.oracle_sql()["op11_manifest"])
    want = compare.rows_of([c[0] for c in result.description], result.fetchall())
    got = queries.op11_manifest(spark, str(tmp_path))
    assert compare.rows_of(got.columns, got.collect()) == want


def test_intervals_nest(spark):
    rows = documents(6, [("a", 40), ("b", 5)])
    found = merkle.manifest(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.source, r.lo) for r in found) == [("a", i) for i in range(40)] + [("b", i) for i in range(5)]
    assert {len(r.path) for r in found if r.source == "a"} == {3}  # two levels of its own, one above


TEXTS = [
    None, "", " ", "   ", "a", " a", "a ", "a  b   c ", "▁", "▁▁x▁", "a▁b", "a\nb\tc\r\n", "a\x00b", "<s> hi </s> <unk>",
    "<0x0A>", "ﬁ é é Ａ　x\xa0y", "😀 emoji 👩‍👩‍👧 zw", "漢字かな交じり文 中文", "привет, мир", "퟿ \U0010ffff",
    "repeat repeat repeat", "x" * 5_000, "don't stop--now!!", "a" + " " * 300 + "b", LONG,
]


def test_pieces(spark):
    draw = random.Random(12)
    signs = "ab  ▁e\n\té漢😀.,'"
    texts = TEXTS + ["".join(draw.choice(signs) for _ in range(draw.randrange(60))) for _ in range(400)]
    rows = [(i, t, "mine") for i, t in enumerate(texts)] + [(3, " ", "again"), (None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    docs = docs.withColumns({c: F.lit(c) for c in ("block", "rows", "chunk", "plain", "rest", "none", "a.b")})
    found = pieces.encoded(docs, pieces.load(MODEL))
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "")
        want.append((doc_id, ids, library.decode(ids)))
    rows = found.collect()
    assert sorted([(r.doc_id, r.ids, r.decoded) for r in rows], key=str) == sorted(want, key=str)
    assert {(r.block, r.rest, r["a.b"]) for r in rows} == {("block", "rest", "a.b")}
    assert pieces.encoded(docs.limit(0), pieces.load(MODEL)).collect() == []


def test_pieces_in_many_blocks(spark, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [f"{'some words and ' * (i % 40)} number {i}" for i in range(300)]
    batches = [pieces.pa.RecordBatch.from_arrays([pieces.pa.array(texts)], ["text"])]
    monkeypatch.setattr(pieces, "BLOCK_BYTES", 2_000)
    cut = list(pieces._cut(batches))
    assert len(cut) > 40 and sum(b.num_rows for b in cut) == 300
    assert max(sum(map(len, b.column(0).to_pylist())) for b in cut) <= 2_000
    docs = spark.createDataFrame(enumerate(texts), "doc_id long, text string").repartition(7)
    found = pieces.encoded(docs, pieces.load(MODEL)).collect()
    assert {r.doc_id: r.ids for r in found} == {i: library.encode(t) for i, t in enumerate(texts)}


def test_chunks():
    """Marked words without their first marker."""
    chunks = pieces.chunks_of("the  cat the cat the ")
    assert chunks == ["the", " cat", "the", "cat", "the", ""]


def test_a_shard_encodes_each_distinct_chunk_once(monkeypatch):
    asked = []

    class Counting(sentencepiece.SentencePieceProcessor):
        def encode(self, texts, **options):
            asked.extend(texts if isinstance(texts, list) else [])
            return super().encode(texts, **options)

    monkeypatch.setattr(pieces.sentencepiece, "SentencePieceProcessor", Counting)
    monkeypatch.setattr(pieces.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    monkeypatch.setattr(pieces, "BLOCK_BYTES", 40)
    texts = ["the cat and the dog", "the dog  and a cat ", "the end"] * 4
    batch = pieces.pa.RecordBatch.from_arrays([pieces.pa.array(texts), pieces.pa.array([{"i": 1}] * 12)], ["text", "rest"])
    rows = [r for r in pieces._blocks([batch], 1) if r.column(1)[0].as_py() != pieces._PLACES]
    assert len(rows) > 3
    list(pieces._answers(rows, pieces.load(MODEL)))
    assert sorted(asked) == sorted({c for t in texts for c in pieces.chunks_of(t)})


def test_pieces_must_not_cross_markers():
    class Crossing:
        def vocab_size(self):
            return 1

        def id_to_piece(self, i):
            return "▁of▁the"

    with pytest.raises(ValueError, match="crosses"):
        pieces.check(Crossing())


def whitened_by_hand(rows, most=16):
    kept = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    whole = np.array([np.floor(64 * v) + 1_000_000 for _, v in kept])
    fit = np.unique(whole, axis=0)
    centred = fit - fit.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(fit))
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    sums = [int(s) for s in fit.sum(0)]
    deviation = [sum((len(fit) * int(x) - s) ** 2 for x, s in zip(row, sums)) for row in whole]
    share = values / (centred**2).sum() * len(fit)
    return kept, len(fit), deviation, np.abs((whole - fit.mean(0)) @ vectors / np.sqrt(values)), share


@pytest.mark.parametrize("dims, most", [(20, 16), (5, 5)])
def test_whitening(spark, dims, most):
    random_ = np.random.default_rng(dims)
    turn = random_.normal(size=(dims, dims))
    rows = [(i, (random_.normal(size=dims) @ turn).tolist()) for i in range(200)]
    rows += [(1_000 + i, rows[7][1]) for i in range(150)] + [(None, rows[3][1]), (5, rows[5][1])]
    rows += [(2_000, None), (2_001, []), (2_002, [None] * dims), (2_003, [float("nan")] * dims)]
    rows += [(2_004, [float("inf")] + [0.0] * (dims - 1)), (2_005, [1e300] + [0.0] * (dims - 1))][:1]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = vectors.withColumns({c: F.lit("mine") for c in ("n", "component", "dims", "packed")}).repartition(5)
    kept, n, deviation, want, share = whitened_by_hand(rows)
    found = whitening.whitened(vectors).collect()
    assert len(found) == most * len(kept) and {r.n for r in found} == {n} == {200}
    by_id = {(r.vec_id, r.component): r for r in found}
    signs = {}
    for (vec_id, _), d, line in zip(kept, deviation, want):
        for k in range(most):
            row = by_id[vec_id, k + 1]
            assert row.deviation == d and abs(abs(row.whitened) - line[k]) < 1e-9
            assert abs(row.explained - share[k]) < 1e-12 and row.identity_error < 1e-10
    for r in found:  # the same sign for equal vectors
        if r.vec_id in (7, 1_000, 1_149):
            signs.setdefault(r.component, set()).add(r.whitened)
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], schema)).collect() == []
    same = [(i, [1.0, 2.0]) for i in range(5)]
    assert whitening.whitened(spark.createDataFrame(same, schema)).collect() == []
    line = [(i, [float(i), 2.0 * i, 7.0]) for i in range(5)]
    other = [(10 + i, [float(i % 2), float(i // 2)]) for i in range(4)]
    found = whitening.whitened(spark.createDataFrame(line + other, schema)).collect()
    assert {(r.vec_id < 10, r.component) for r in found} == {(True, 1), (False, 1), (False, 2)}
    assert all(abs(r.explained - (1.0 if r.vec_id < 10 else 0.5)) < 1e-12 for r in found)


def test_deviations_are_exact_or_null():
    rows = np.array([[3, -(1 << 40)], [0, 5], [1 << 62, 0]], np.int64)
    model = whitening.Whitening(3, [int(s) for s in rows.astype(object).sum(0)], np.zeros(0), np.zeros((0, 2)), 0.0)
    want = [sum((3 * int(x) - s) ** 2 for x, s in zip(row, model.sums)) for row in rows.tolist()]
    assert whitening.deviations(rows, model).to_pylist() == [w if w < 1 << 63 else None for w in want]
    small = np.array([[30_000, -5], [2, 9]], np.int64)
    model = whitening.Whitening(70_000, [11, -3], np.zeros(0), np.zeros((0, 2)), 0.0)
    want = [sum((70_000 * int(x) - s) ** 2 for x, s in zip(row, model.sums)) for row in small.tolist()]
    assert whitening.deviations(small, model).to_pylist() == want


MATRICES = {
    "one": np.array([[3.0]]), "two": np.array([[2.0, 1], [1, 2]]), "unit": np.eye(20),
    "equal": np.diag(np.r_[np.ones(5), np.arange(10.0)]),
    "pairs": np.diag(np.abs(np.arange(-10, 11.0))) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1),
}


@pytest.mark.parametrize("name", [*MATRICES, "clusters", "random"])
def test_leading_eigenvectors(name):
    draw = np.random.default_rng(5)
    if name in MATRICES:
        matrix = MATRICES[name]
    else:
        values = np.r_[[5, 5, 5, 4.9999999, 3, 3 + 1e-9], np.linspace(1, 2, 60)] if name == "clusters" else draw.random(66)
        turn = np.linalg.qr(draw.normal(size=(66, 66)))[0]
        matrix = turn @ np.diag(values) @ turn.T
        matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.leading(matrix, 16)
    want = np.linalg.eigvalsh(matrix)[::-1]
    want = want[want > 1e-12][:16]
    assert np.allclose(values, want, rtol=0, atol=1e-13 * want[0])
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-13
    assert np.abs(matrix @ vectors.T - vectors.T * values).max() < 1e-13 * np.abs(matrix).max() * len(matrix)
