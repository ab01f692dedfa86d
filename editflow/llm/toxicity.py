"""Toxicity of texts whose words may be disguised.

Words are restored first, see `deobfuscate`. The restored text is scored by a logistic
regression on whole words and word beginnings that the labelled rows show to be typical of
toxic texts. Each text is read twice: for the letters and disguised strings of the corpus,
and for the score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editflow.functions.skew import lookup_join
from editflow.llm.deobfuscate import BYTES, Signs, both, parts, readings, survey
from editflow.llm.tables import bytes_of, spans, stored

# The classifier is fitted on about SAMPLE labelled rows at most, and has at most FEATURES inputs.
SAMPLE = 200_000
FEATURES = 4_000
LEAST_DOCS = 3
FOLDS = 5
# Word beginnings of so many letters are inputs, besides whole words.
BEGINNINGS = (4, 5, 6, 8)
# Rows whose words are counted at once, and counts that a task holds.
ROWS, HELD = 128, 300_000


def beginnings(word: str) -> list[str]:
    """What the classifier sees of a word: the whole of it, and its first letters."""
    return [f"{word}$", *(word[:n] for n in BEGINNINGS if len(word) > n)]


@dataclass
class ToxicityModel:
    index: dict[str, int]
    weights: np.ndarray
    bias: float
    heads: set[str] = field(default_factory=set)

    def __post_init__(self) -> None:
        # The first four letters of all words that have an input, or the whole of shorter ones.
        self.heads = {x.removesuffix("$")[:4] for x in self.index}

    def hits(self, words: Iterable[str]) -> set[int]:
        some = [word for word in words if word[:4] in self.heads]
        return {self.index[x] for word in some for x in beginnings(word) if x in self.index}

    def score(self, hits: Iterable[int]) -> float:
        logit = self.bias + float(self.weights[list(hits)].sum())
        return float(1 / (1 + np.exp(-np.clip(logit, -50, 50))))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text, toxic of the rows to learn from: crc32 of the id leaves a remainder other than 0.

    If there are more than `sample` labels, those whose ids' hashes lie below a cutoff that
    leaves about so many, so the table of labels is small.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    known = known.where("doc_id is not null and toxic is not null")
    known = known.where(F.crc32(F.col("doc_id").cast("string")) % FOLDS != 0)
    known = stored(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    total = known.count()
    if total > sample:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < (1 << 40) * sample // total)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.join(F.broadcast(known), "doc_id").select("text", "toxic")


def _scan(batches: Iterable[pa.RecordBatch], model: ToxicityModel | None) -> Iterator[pa.RecordBatch]:
    """Rows without text, with a number, the words or the model's inputs among them, and the strings to decode."""
    task, number = TaskContext.get().partitionId() << 33, 0
    for batch in batches:
        at = batch.schema.get_field_index("text")
        rest = batch.schema.remove(at)
        for low, high in spans(bytes_of(batch.column(at))[1], BYTES):
            part = batch.slice(low, high - low)
            signs = Signs.of(part.column(at).to_pylist())
            spaced, tripled = signs.spaced(), signs.tripled()
            found, strings = [], []
            for i, text in enumerate(signs.texts):
                words, hidden = parts(text, i in spaced, i in tripled)
                found.append(sorted(words) if model is None else sorted(model.hits(words)))
                strings.append(sorted(hidden))
            numbers = np.arange(number, number + part.num_rows) + task
            number += part.num_rows
            kind = pa.string() if model is None else pa.int32()
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(name) for name in rest.names),
                    pa.array(numbers),
                    pa.array(found, pa.list_(kind)),
                    pa.array(strings, pa.list_(pa.string())),
                ],
                names=[*rest.names, "_row", "_found", "_strings"],
            )


def scanned(docs: DataFrame, model: ToxicityModel | None = None) -> DataFrame:
    """docs without text, stored, with _row, _found (words, or inputs of the model) and _strings."""
    kept = [f for f in docs.schema.fields if f.name != "text"]
    found = T.ArrayType(T.StringType() if model is None else T.IntegerType())
    new = [("_row", T.LongType()), ("_found", found), ("_strings", T.ArrayType(T.StringType()))]
    layout = T.StructType([*kept, *[T.StructField(name, kind) for name, kind in new]])
    return stored(docs.mapInArrow(partial(_scan, model=model), layout), "scanned")


def _with_readings(rows: DataFrame, known: DataFrame, value: str) -> DataFrame:
    """rows with _more, the values that the table (string, value) has of their strings."""
    asked = rows.select("_row", F.explode("_strings").alias("string"))
    met = lookup_join(asked, known, ["string"], spread=["_row"])
    more = met.groupBy("_row").agg(F.collect_set(value).alias("_more"))
    return rows.join(more, "_row", "left")


def fit(docs: DataFrame, labels: DataFrame, known: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """The classifier; known (string, reading) are the readings of the corpus' disguised strings."""
    learn = _with_readings(scanned(labelled(docs, labels, sample)), known, "reading")
    learn = stored(learn.select("toxic", "_found", "_more"), "learn")
    tally = learn.mapInArrow(_tally, "feature string, toxic long, clean long")
    tally = tally.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    tally = stored(tally.where((F.col("feature") == "") | (F.col("toxic") >= LEAST_DOCS)), "tally")
    total = tally.where("feature = ''").first()
    if total is None or not total["toxic"] or not total["clean"]:
        share = 0.0 if total is None or not total["toxic"] else 1.0
        return ToxicityModel({}, np.zeros(0), 20.0 * (2 * share - 1))
    rate = (F.col("toxic") + 0.5) / total["toxic"] / ((F.col("clean") + 0.5) / total["clean"])
    typical = tally.where(F.col("feature") != "").withColumn("rate", rate).where("rate > 8")
    typical = typical.orderBy((F.col("toxic") * F.log("rate")).desc(), "feature").limit(FEATURES)
    names = [r["feature"] for r in typical.select("feature").collect()]
    model = ToxicityModel({x: i for i, x in enumerate(names)}, np.zeros(len(names)), 0.0)
    rows = learn.mapInArrow(partial(_inputs, model=model), "toxic int, hits array<int>, rows long")
    merged = rows.groupBy("toxic", "hits").agg(F.sum("rows").alias("rows")).collect()
    merged.sort(key=lambda r: (r["toxic"], r["hits"]))
    model.weights, model.bias = _regress(merged, len(names))
    return model


def _read_words(more: list[str] | None) -> list[str]:
    return [word for reading in more or () for word in both(reading)]


def _tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each kind that hold a feature; the empty feature stands for all texts."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            part = batch.slice(low, ROWS)
            toxic = pc.cast(pc.greater(part.column(0), 0), pa.int64())
            hidden = [(i, w) for i, more in enumerate(part.column(2).to_pylist()) for w in _read_words(more)]
            rows = np.concatenate([pc.list_parent_indices(part.column(1)), [i for i, _ in hidden]]).astype(np.int64)
            words = pa.concat_arrays([pc.list_flatten(part.column(1)), pa.array([w for _, w in hidden], pa.string())])
            length = pc.utf8_length(words).to_numpy(zero_copy_only=False)
            features = [pc.binary_join_element_wise(words, "$", "")]
            owners = [rows]
            for n in BEGINNINGS:
                longer = length > n
                features.append(pc.utf8_slice_codeunits(words.filter(pa.array(longer)), 0, n))
                owners.append(rows[longer])
            owner = pa.array(np.concatenate(owners))
            pairs = pa.table({"row": owner, "feature": pa.concat_arrays(features)})
            pairs = pairs.group_by(["row", "feature"]).aggregate([])
            marked = pa.table({"feature": pairs["feature"], "toxic": toxic.take(pairs["row"])})
            whole = pa.table({"feature": pa.array([""] * part.num_rows, pa.string()), "toxic": toxic})
            both_kinds = pa.concat_tables([marked, whole]).append_column(
                "clean", pc.subtract(1, pa.concat_tables([marked, whole])["toxic"])
            )
            held.append(_summed(both_kinds))
            size += len(held[-1])
            if size > HELD:
                yield from _summed(pa.concat_tables(held)).to_batches(max_chunksize=50_000)
                held, size = [], 0
                pa.default_memory_pool().release_unused()
    if held:
        yield from _summed(pa.concat_tables(held)).to_batches()


def _summed(counts: pa.Table) -> pa.Table:
    summed = counts.group_by("feature").aggregate([("toxic", "sum"), ("clean", "sum")])
    return pa.table({"feature": summed["feature"], "toxic": summed["toxic_sum"], "clean": summed["clean_sum"]})


def _inputs(batches: Iterable[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = [int(x > 0) for x in batch.column(0).to_pylist()]
        words = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        hits = [tuple(sorted(model.hits([*shown, *_read_words(more)]))) for shown, more in words]
        counted = Counter(zip(toxic, hits))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x for x, _ in counted], pa.int32()),
                pa.array([list(h) for _, h in counted], pa.list_(pa.int32())),
                pa.array(list(counted.values()), pa.int64()),
            ],
            ["toxic", "hits", "rows"],
        )


def _regress(rows: list, features: int, steps: int = 400, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression by gradient steps with adapted lengths; deterministic."""
    owner = np.repeat(np.arange(len(rows)), [len(r["hits"]) for r in rows])
    at = np.array([h for r in rows for h in r["hits"]], np.int64)
    label = np.array([r["toxic"] for r in rows], float)
    many = np.array([r["rows"] for r in rows], float)
    weights, bias = np.zeros(features), 0.0
    moved, slid = np.zeros(features), 0.0
    for step in range(steps):
        logit = bias + np.bincount(owner, weights[at], len(rows))
        gap = many * (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - label)
        slope = np.bincount(at, gap[owner], features) + ridge * weights
        moved += slope**2
        slid += gap.sum() ** 2
        weights = np.maximum(0, weights - 0.5 * slope / np.sqrt(moved + 1e-9))
        bias -= 0.5 * gap.sum() / np.sqrt(slid + 1e-9)
    return weights, float(bias)


def scored(docs: DataFrame, model: ToxicityModel, known: DataFrame) -> DataFrame:
    """docs without text, with held_out, score (0 to 1), predicted (1 if score >= 0.5, else 0).

    Null and empty texts score as texts without any input. Columns of docs with the names of
    new ones are replaced, all others but text stay. Equal texts have equal scores.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    rows = docs.withColumns({"held_out": held_out, "text": F.col("text").cast("string")})
    rows = scanned(rows.drop("score", "predicted", "_row", "_found", "_strings", "_more"), model)
    # Of all readings, few have an input of the model.
    typical = known.mapInArrow(partial(_hit_readings, model=model), "string string, hit int")
    rows = _with_readings(rows, stored(typical, "typical"), "hit").drop("_strings", "_row")
    kept = [f for f in rows.schema.fields if f.name not in ("_found", "_more")]
    layout = [*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return rows.mapInArrow(partial(_score, model=model), T.StructType(layout))


def _hit_readings(batches: Iterable[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = [
            (string, hit)
            for string, reading in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for hit in sorted(model.hits(both(reading)))
        ]
        strings, hits = zip(*pairs) if pairs else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(strings, pa.string()), pa.array(hits, pa.int32())], ["string", "hit"])


def _score(batches: Iterable[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        hits = zip(rows["_found"].to_pylist(), rows["_more"].to_pylist())
        scores = np.array([model.score(sorted({*shown, *(more or ())})) for shown, more in hits], float)
        rows = rows.drop_columns(["_found", "_more"])
        yield pa.RecordBatch.from_arrays(
            [*(c.combine_chunks() for c in rows.columns), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
            names=[*rows.column_names, "score", "predicted"],
        )


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """docs (doc_id, text) without text, with held_out, score, predicted; fitted on its labelled rows.

    Without labelled rows of both kinds, every row scores near 0, or near 1 if all are
    toxic. Rows of labels with nulls are ignored; of repeated ids the higher label counts.
    See `scored` for nulls and clashing columns.
    """
    trigrams, strings = survey(docs)
    known = readings(strings, trigrams)
    return scored(docs, fit(docs, labels, known, sample), known)
