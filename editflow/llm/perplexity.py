"""Quality of texts by the perplexity of a language model trained on trusted ones.

The model is an interpolated modified Kneser-Ney model of n-grams of ORDER letters (UTF-16
units, each as it is, so that an n-gram is one 64-bit number), one per language. Its count
tables grow with the trusted texts and stay in shards, dealt by language and n-gram:
continuation counts, discounts, context totals and shares come from joins of them.

Texts are scored in blocks of at most BLOCK bytes, packed and stored. Each block sends its
distinct n-grams to the shards, and what comes back, the shares of those that the model
has, meets the block where it lies. So a task holds a block and its part of the model, never the
whole model. A text is kept if its perplexity is at most that of a quantile of its
language's trusted texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from editflow.llm.tables import bucketed, bytes_of, having, spans, stored

ORDER = 4
UNIT = 16
QUANTILE = 0.98
# Perplexities are counted in steps of 1 / STEPS of their logarithm for the quantiles.
STEPS = 500
# Bytes of the texts that are counted or scored at once; a longer text is a block of its own.
BLOCK = 16 << 20
# n-grams of a block that are sorted at once.
PIECE = 1 << 20


def _windows(text: str) -> np.ndarray:
    """The ORDER-grams that end at each letter and at a blank after the text; blanks come before it."""
    padded = " " * (ORDER - 1) + text + " "
    units = np.frombuffer(padded.encode("utf-16-le", "replace"), np.uint16).astype(np.uint64)
    out = units[: len(units) - ORDER + 1].copy()
    for k in range(1, ORDER):
        out = out << np.uint64(UNIT) | units[k : len(units) - ORDER + 1 + k]
    return out


def _pieces(texts: Iterable[tuple[int, str]]) -> Iterator[tuple[list[int], list[int], np.ndarray]]:
    """Places, where the grams of each place begin, and grams: at most PIECE of them.

    A text of more than PIECE grams comes in several pieces.
    """
    places: list[int] = []
    parts: list[np.ndarray] = []
    held = 0
    for place, text in texts:
        windows = _windows(text)
        for begin in range(0, len(windows), PIECE):
            part = windows[begin : begin + PIECE]
            if held and held + len(part) > PIECE:
                yield places, np.cumsum([0, *map(len, parts[:-1])]).tolist(), np.concatenate(parts)
                places, parts, held = [], [], 0
            places.append(place)
            parts.append(part)
            held += len(part)
    if held:
        yield places, np.cumsum([0, *map(len, parts[:-1])]).tolist(), np.concatenate(parts)


def _last(grams: np.ndarray, n: int) -> np.ndarray:
    """The last n letters of each gram."""
    return grams & np.uint64((1 << UNIT * n) - 1)


def _parts(grams: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Distinct n-grams for n from 0 to ORDER that the probabilities of `grams` are made of."""
    for n in range(ORDER + 1):
        found = [_last(grams, n)]
        if n < ORDER:
            found.append(_last(grams >> np.uint64(UNIT), n))
        yield n, np.unique(np.concatenate(found))


def _language() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")


def _text(value: pa.Scalar) -> str:
    return value.as_buffer().to_pybytes().decode("utf-8", "replace") if value.is_valid else ""


def _texts(batch: pa.RecordBatch, lang: str) -> dict[str, list[tuple[int, str]]]:
    """Places and texts per language, without empty ones."""
    found: dict[str, list[tuple[int, str]]] = {}
    langs = batch.column(batch.schema.get_field_index(lang)).to_pylist()
    texts = batch.column(batch.schema.get_field_index("text"))
    for place, (name, value) in enumerate(zip(langs, texts)):
        if text := _text(value):
            found.setdefault(name, []).append((place, text))
    return found


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, starts = bytes_of(batch.column(batch.schema.get_field_index("text")))
        for begin, end in spans(starts, BLOCK):
            yield batch.slice(begin, end - begin)


def gram_counts(texts: DataFrame) -> DataFrame:
    """lang, gram, count of the ORDER-grams of all texts (lang, text), combined in each piece first."""
    rows = texts.mapInArrow(_count, "lang string, gram long, count long")
    return rows.groupBy("lang", "gram").agg(F.sum("count").alias("count"))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _cut(batches):
        for lang, held in _texts(batch, "lang").items():
            for _, _, windows in _pieces(held):
                grams, many = np.unique(windows, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(many)],
                    ["lang", "gram", "count"],
                )


def _discounts(counts: DataFrame) -> DataFrame:
    """lang, d1, d2, d3: how much a count of 1, 2, or more is lowered, from counts of counts."""
    how_many = [F.count_if(F.col("count") == k).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    sums = counts.groupBy("lang").agg(*how_many)
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def lowered(k: int) -> Column:
        usual = k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")
        defined = (F.col("n1") + F.col("n2") > 0) & (F.col(f"n{k}") > 0)
        return F.when(defined, F.greatest(F.lit(0.0), F.least(F.lit(float(k)), usual))).otherwise(F.lit(0.5 * k)).alias(f"d{k}")

    return sums.select("lang", *(lowered(k) for k in (1, 2, 3)))


def _shares(counts: DataFrame, n: int) -> DataFrame:
    """lang, n, gram with the share of an n-gram among those of its context after discounting,
    and with what a context leaves to shorter ones.

    counts: lang, gram, count. They are joined with discounts by language and with totals
    by language and context.
    """
    given = counts.join(stored(_discounts(counts), "discounts"), "lang")
    count = F.col("count")
    off = F.when(count == 1, F.col("d1")).when(count == 2, F.col("d2")).otherwise(F.col("d3"))
    given = given.withColumn("off", F.least(off, count.cast("double")))
    given = given.withColumn("context", F.shiftrightunsigned("gram", UNIT))
    totals = given.groupBy("lang", "context").agg(F.sum("count").alias("total"), F.sum("off").alias("left"))
    totals = stored(totals, "totals")
    share = ((count - F.col("off")) / F.col("total")).alias("share")
    none = F.lit(None).cast("double")
    grams = given.join(totals, ["lang", "context"]).select(
        "lang", F.lit(n).alias("n"), "gram", share, none.alias("rest")
    )
    rest = (F.col("left") / F.col("total")).alias("rest")
    contexts = totals.select(
        "lang", F.lit(n - 1).alias("n"), F.col("context").alias("gram"), none.alias("share"), rest
    )
    return grams.unionByName(contexts)


def model_of(counts: DataFrame) -> DataFrame:
    """lang, n, gram, share, rest: one row per n-gram that occurs, or is a context, for n from 0 to ORDER.

    The empty gram's share is the chance of any letter, one that never occurs among them.
    """
    held = stored(counts, "grams")
    parts = []
    for n in range(ORDER, 0, -1):
        parts.append(_shares(held, n))
        if n > 1:  # shorter grams count the letters that they follow
            shorter = F.col("gram").bitwiseAND(F.lit((1 << UNIT * (n - 1)) - 1).cast("long"))
            held = stored(held.groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("count")), "grams")
    letters = held.groupBy("lang").agg((1 / (F.count("*") + 1)).alias("share"))
    none = F.lit(None).cast("double").alias("rest")
    zero = F.lit(0).cast("long").alias("gram")
    rows = letters.select("lang", F.lit(0).alias("n"), zero, "share", none)
    for part in parts:
        rows = rows.unionByName(part)
    rows = rows.groupBy("lang", "n", "gram").agg(F.max("share").alias("share"), F.max("rest").alias("rest"))
    return stored(rows, "model")


def perplexities(docs: DataFrame, model: DataFrame) -> DataFrame:
    """docs without text, with log_perplexity: null for null and empty texts, and for languages without a model.

    docs is read once: its blocks are numbered and stored, so that a lost executor changes
    neither. They lie in buckets; only the model's answers move to meet them.
    """
    rows = docs.drop("log_perplexity", "_lang").withColumn("_lang", _language())
    rows = rows.withColumn("text", F.col("text").cast("string"))
    packed = rows.mapInArrow(_packed, "block long, rows binary")
    blocks = bucketed(packed, _block_count(rows), "block")
    asked = blocks.mapInArrow(_asked, "block long, lang string, n int, gram long")
    answers = asked.join(model, ["lang", "n", "gram"], "left")
    # The empty gram of each block and language stays, with or without a model.
    answers = answers.where("n = 0 or share is not null or rest is not null").select(
        "block", "lang", "n", "gram", F.col("share").cast("float"), F.col("rest").cast("float")
    )
    kept = [field for field in rows.schema.fields if field.name not in ("text", "_lang")]
    schema = StructType([*kept, StructField("log_perplexity", DoubleType())])
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score, schema)


def _block_count(rows: DataFrame) -> int:
    """About the number of blocks, so that a task holds a few of them however many there are."""
    return int(rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]) // BLOCK


def _asked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for held in batches:
        for block, packed in zip(held.column("block").to_pylist(), held.column("rows")):
            yield from _asked_by(block, pa.ipc.open_stream(packed.as_buffer()).read_next_batch())


def _asked_by(block: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for lang, held in _texts(batch, "_lang").items():
        whole = np.unique(np.concatenate([np.unique(windows) for _, _, windows in _pieces(held)]))
        for n, grams in _parts(whole):
            many = len(grams)
            columns = [
                pa.array(np.full(many, block)), pa.array([lang] * many, pa.string()),
                pa.array(np.full(many, n, np.int32)), pa.array(grams.view(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["block", "lang", "n", "gram"])


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with a number made of their partition and place."""
    part = TaskContext.get().partitionId()
    for place, batch in enumerate(_cut(batches)):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        packed = sink.getvalue().to_pybytes()
        columns = [pa.array([part << 32 | place]), pa.array([packed], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["block", "rows"])


def _score(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    parts = []
    for packed in blocks.column("rows"):
        batch = pa.ipc.open_stream(packed.as_buffer()).read_next_batch()
        scores: list[float | None] = [None] * batch.num_rows
        for lang, held in _texts(batch, "_lang").items():
            mine = answers.filter(pc.equal(answers.column("lang"), lang))
            costs = _costs(mine)
            if costs is None:
                continue
            totals, many = Counter(), Counter()
            for places, begins, windows in _pieces(held):
                grams, at = np.unique(windows, return_inverse=True)
                sums = np.add.reduceat(costs(grams)[at], begins).tolist()
                for place, total, begin, end in zip(places, sums, begins, [*begins[1:], len(windows)]):
                    totals[place] += total
                    many[place] += end - begin
            for place, _ in held:
                scores[place] = totals[place] / many[place]
        wanted = [name for name in batch.schema.names if name not in ("text", "_lang")]
        table = pa.Table.from_batches([batch]).select(wanted)
        parts.append(table.append_column("log_perplexity", pa.array(scores, pa.float64())))
    return pa.concat_tables(parts)


def _costs(answers: pa.Table):
    """A function from ORDER-grams to their costs, or None without a model."""
    n = answers.column("n").to_numpy()
    grams = answers.column("gram").to_numpy().view(np.uint64)
    share = answers.column("share").to_numpy().astype(np.float64)
    rest = answers.column("rest").to_numpy().astype(np.float64)
    base = share[n == 0][0]
    if np.isnan(base):
        return None
    tables = []
    for size in range(ORDER + 1):
        rows = np.flatnonzero(n == size)
        rows = rows[np.argsort(grams[rows])]
        tables.append((grams[rows], np.nan_to_num(share[rows]), np.where(np.isnan(rest[rows]), 1.0, rest[rows])))

    def of(wanted: np.ndarray, size: int, column: int, missing: float) -> np.ndarray:
        keys = tables[size][0]
        if len(keys) == 0:
            return np.full(len(wanted), missing)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, tables[size][column][at], missing)

    def costs(whole: np.ndarray) -> np.ndarray:
        chance = np.full(len(whole), base)
        for size in range(1, ORDER + 1):
            left = of(_last(whole >> np.uint64(UNIT), size - 1), size - 1, 2, 1.0)
            chance = of(_last(whole, size), size, 1, 0.0) + left * chance
        return -np.log(np.maximum(chance, 1e-12))

    return costs


def quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """docs (doc_id, text, lang) without text, with log_perplexity, threshold, kept.

    Trusted are the documents that labels (doc_id, quality) mark 1. kept says that
    log_perplexity is at most the `quantile` of the trusted texts of the language. Null
    and empty texts have no perplexity and are not kept; texts in a language without
    trusted text have no threshold and are kept. A null language is one of its own.
    Columns of docs with the names of new ones are replaced, all others stay.
    """
    docs = docs.drop("log_perplexity", "threshold", "kept", "_empty")
    trusted = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    trusted = stored(trusted, "trusted")
    good = having(docs, trusted, "doc_id")
    model = model_of(gram_counts(good.select(_language(), F.col("text").cast("string"))))
    empty = F.coalesce(F.octet_length("text") == 0, F.lit(True))
    scored = stored(perplexities(docs.withColumn("_empty", empty), model), "scored")
    step = F.ceil(F.col("log_perplexity") * STEPS).cast("long")
    known = having(scored, trusted, "doc_id").where("log_perplexity is not null")
    counts = known.groupBy(_language(), step.alias("step")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("lang").orderBy("step")
    whole = Window.partitionBy("lang")
    below = counts.select(
        "lang", "step", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("all")
    )
    limits = below.where(F.col("upto") >= F.col("all") * quantile).groupBy("lang")
    limits = stored(limits.agg((F.min("step") / F.lit(float(STEPS))).alias("threshold")), "limits")
    limits = limits.withColumnRenamed("lang", "_lang")
    rows = scored.withColumn("_lang", _language()).join(limits, "_lang", "left").drop("_lang")
    within = F.col("log_perplexity") <= F.col("threshold")
    unknown = F.col("threshold").isNull() & ~F.col("_empty")
    return rows.withColumn("kept", F.coalesce(within, unknown, F.lit(False))).drop("_empty")
