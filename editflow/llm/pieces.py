"""Encoding and decoding of texts by a SentencePiece model, word by distinct word.

The model's normalised text is the text with a marker (U+2581) in front and in place of
each space. If no piece holds a marker behind another sign, then no piece crosses the place
before a run of markers that follows another sign. Between such places lie the text's
chunks: marked words. Each is encoded as if it stood alone, so each distinct one in all
texts is encoded only once, by the library itself, and the results are joined back to the
places where it stands.

Texts are read once, in blocks. A block becomes its distinct chunks, dealt by a hash into
shards of the chunk table, and for each text the places of its chunks among them. A shard
sees the chunks of all blocks, looks each distinct one up or encodes it, and answers every
block in the block's order. A block decodes each of its distinct chunks once, by the library
too; its answers and places together give its texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editflow.llm.tables import bucketed, bytes_of, shuffle_width, spans

MARK = "▁"
_CHUNK = re.compile(" +[^ ]*")
# Texts go in blocks of at most so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 16 << 20
# A shard of the table is meant for the chunks of so many bytes of text; there are SHARDS at most.
SHARD_BYTES = 16 << 20
SHARDS = 4_096
# A shard that has met more distinct chunks than this begins its table anew, so memory is bounded.
MOST = 500_000
# So many chunks are handed to the library at once.
AT_ONCE = 4_096
_NEW = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
# What a block holds besides its shards.
_PLACES = -1


def load(path: str) -> bytes:
    """A model's bytes (a vocabulary, far below a few MB), checked to keep chunks apart."""
    with open(path, "rb") as file:
        model = file.read()
    check(sentencepiece.SentencePieceProcessor(model_proto=model))
    return model


def check(processor: sentencepiece.SentencePieceProcessor) -> None:
    """Stop if a piece crosses a whitespace marker, or the model changes texts before it encodes them."""
    for number in range(processor.vocab_size()):
        piece = processor.id_to_piece(number)
        if MARK in piece.lstrip(MARK):
            raise ValueError(f"the piece {piece!r} crosses a whitespace marker")
    for text in (" a  b ", "ﬁ　Ａ é\tz\n"):
        if processor.normalize(text) != marked(text):
            raise ValueError("the model does not keep texts as they are, with a marker in front")


def marked(text: str) -> str:
    return MARK + text.replace(" ", MARK)


def chunks_of(text: str) -> list[str]:
    """The marked words of a text in order, each without its first marker, other markers as spaces."""
    if not text:
        return []
    words = text.replace(MARK, " ").split(" ")
    if "" in words:  # a run of spaces belongs to the word after it
        return [chunk[1:] for chunk in _CHUNK.findall(" " + text.replace(MARK, " "))]
    return words


def encoded(docs: DataFrame, model: bytes) -> DataFrame:
    """docs with ids (array<int>) and decoded (string) in place of text and of columns with these names.

    ids are what the library's encode(text) returns, without begin or end ids, and decoded
    is what its decode(ids) returns. Null and empty texts have no ids and an empty decoded
    text. Every row of docs gives one row, repeated ones too; an empty table gives none.
    Other columns stay, whatever their names.
    """
    rows = docs.drop("ids", "decoded")
    kept = [f for f in rows.schema.fields if f.name.lower() != "text"]
    rest = F.struct(*[F.col(_quoted(f.name)) for f in kept]) if kept else F.struct(F.lit(0).alias("none"))
    typed = rows.select(F.col("text").cast("string"), rest.alias("rest"))
    spark = docs.sparkSession
    size = int(typed.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
    shards = min(SHARDS, max(shuffle_width(spark), size // SHARD_BYTES))
    layout = "block long, shard int, data binary"
    # Written once: the numbers of the blocks, and their order of chunks, are then fixed. As the
    # table is in buckets of blocks, only the shards' answers move to meet a block's places.
    blocks = typed.mapInArrow(partial(_blocks, shards=shards), layout)
    blocks = bucketed(blocks, size // BLOCK_BYTES, "block")
    asked = blocks.where(F.col("shard") != _PLACES).repartition(shards, "shard")
    answers = asked.sortWithinPartitions("shard").mapInArrow(partial(_answers, model=model), layout)
    places = blocks.where(F.col("shard") == _PLACES).select("block", "data")
    inner = T.StructType([*typed.schema.fields[1:], *_NEW])
    joined = places.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda held, found: _join(held, found, model), inner
    )
    return joined.select(*[F.col("rest")[f.name].alias(f.name) for f in kept], "ids", "decoded")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition in pieces of at most BLOCK_BYTES of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        starts = bytes_of(batch.column(0))[1]
        for begin, end in spans(starts, BLOCK_BYTES):
            more = int(starts[end] - starts[begin])
            if held and size + more > BLOCK_BYTES:
                yield _one(held)
                held, size = [], 0
            held.append(batch.slice(begin, end - begin))
            size += more
    if held:
        yield _one(held)


def _one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _press(*parts: bytes | np.ndarray) -> bytes:
    """Byte strings in one compressed piece, with their number and lengths in front."""
    raw = [p if isinstance(p, bytes) else p.tobytes() for p in parts]
    head = np.array([len(raw), *map(len, raw)], np.uint64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(raw))


def _unpress(data: bytes) -> list[bytes]:
    whole = zstandard.ZstdDecompressor().decompress(data)
    many = int(np.frombuffer(whole, np.uint64, 1)[0])
    ends = 8 * (many + 1) + np.cumsum(np.append(0, np.frombuffer(whole, np.uint64, many, 8))).astype(int)
    return [whole[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]


def _planes(numbers: np.ndarray) -> bytes:
    """Whole numbers with their low bytes together, then the next ones: far smaller when compressed."""
    return np.ascontiguousarray(numbers.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _ends(lengths: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(lengths, dtype=np.int64))


def _blocks(batches: Iterable[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """A row of places for each block, and a row of distinct chunks for each of its shards."""
    part = TaskContext.get().partitionId()
    for number, batch in enumerate(_cut(b for b in batches if b.num_rows)):
        yield from _block(part << 32 | number, batch, shards)


def _block(block: int, batch: pa.RecordBatch, shards: int) -> Iterator[pa.RecordBatch]:
    index: dict[str, int] = {}
    found, many = [], []
    for text in batch.column(0):
        chunks = chunks_of(text.as_py()) if text.is_valid else []
        many.append(len(chunks))
        found.append(np.fromiter([index.setdefault(c, len(index)) for c in chunks], np.int32, len(chunks)))
    raw = [chunk.encode() for chunk in index]
    del index
    words = np.concatenate(found)
    del found
    # Frequent chunks get small numbers; `place` tells where each is among the shards' sorted lists.
    often = np.argsort(-np.bincount(words, minlength=len(raw)), kind="stable")
    rank = np.empty(len(raw), np.int32)
    rank[often] = np.arange(len(raw), dtype=np.int32)
    dealt = np.fromiter((zlib.crc32(chunk) % shards for chunk in raw), np.int32, len(raw))
    place = np.empty(len(raw), np.int32)
    by_shard = np.argsort(dealt, kind="stable")
    edges = np.searchsorted(dealt[by_shard], np.arange(shards + 1))
    for shard, (begin, end) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        if begin < end:
            some = sorted(by_shard[begin:end].tolist(), key=raw.__getitem__)
            place[rank[some]] = np.arange(begin, end, dtype=np.int32)
            chunks = [raw[i] for i in some]
            yield _row(block, shard, _press(_planes(np.array([len(c) for c in chunks])), b"".join(chunks)))
    del raw
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema.remove(0)) as out:
        out.write_batch(batch.select(["rest"]))
    rest = sink.getvalue().to_pybytes()
    yield _row(block, _PLACES, _press(_planes(np.array(many)), _planes(rank[words]), _planes(place), rest))


def _row(block: int, shard: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([shard], pa.int32()), pa.array([data], pa.binary())],
        ["block", "shard", "data"],
    )


def _answers(batches: Iterable[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    """Ids of the chunks that each block has in a shard, in the block's order.

    The table of a shard lives in its task, see MOST.
    """
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    table: dict[bytes, bytes] = {}
    last = None
    for batch in batches:
        for block, shard, data in zip(*(batch.column(i) for i in range(3))):
            if shard != last or len(table) > MOST:
                table, last = {}, shard
            lengths, whole = _unpress(data.as_py())
            ends = _ends(_numbers(lengths)).tolist()
            chunks = [whole[a:b] for a, b in zip(ends, ends[1:])]
            _segment([c for c in chunks if c not in table], table, processor)
            ids = [table[c] for c in chunks]
            flat = np.frombuffer(b"".join(ids), np.int32)
            data = _press(_planes(np.array([len(x) // 4 for x in ids])), _planes(flat))
            yield _row(block.as_py(), shard.as_py(), data)


def _segment(
    chunks: list[bytes], table: dict[bytes, bytes], processor: sentencepiece.SentencePieceProcessor
) -> None:
    """Put the ids of chunks into the table; the library adds the first marker itself."""
    for begin in range(0, len(chunks), AT_ONCE):
        part = chunks[begin : begin + AT_ONCE]
        ids = processor.encode([chunk.decode() for chunk in part], num_threads=1)
        # The library gives an empty text no marker; here it is the space that ends a text.
        for chunk, found in zip(part, ids):
            table[chunk] = np.array(found if chunk else alone(processor), np.int32).tobytes()


def alone(processor: sentencepiece.SentencePieceProcessor) -> list[int]:
    """Ids of a marker that nothing follows."""
    return processor.encode("x ")[len(processor.encode("x")) :]


def _join(held: pa.Table, found: pa.Table, model: bytes) -> pa.Table:
    """The texts of a block: at each place the ids and the plain text of its chunk."""
    many, words, place, rest = _unpress(held["data"][0].as_py())
    in_order = sorted(zip(found["shard"].to_pylist(), found["data"].to_pylist()))
    answers = [_unpress(data) for _, data in in_order]
    none = [np.zeros(0, np.int32)]
    first = _ends(np.concatenate([_numbers(a[0]) for a in answers] or none))
    flat = np.concatenate([_numbers(a[1]) for a in answers] or none)
    plain = _decoded(flat, first, model)
    del answers, in_order
    words = _numbers(place)[_numbers(words)]
    taken = np.diff(first)[words]
    ends = np.cumsum(taken)
    at = np.repeat(first[words] - (ends - taken), taken)
    at += np.arange(len(at))
    ids = flat[at]
    edges = _ends(_numbers(many))
    upto = np.append(0, ends)[edges]
    del at, taken, ends, flat
    bounds = edges.tolist()
    decoded = [" ".join([plain[i] for i in words[a:b].tolist()]) for a, b in zip(bounds, bounds[1:])]
    batch = pa.ipc.open_stream(rest).read_next_batch()
    lists = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids, pa.int32()))
    return pa.table({"rest": batch.column(0), "ids": lists, "decoded": pa.array(decoded, pa.string())})


def _decoded(flat: np.ndarray, first: np.ndarray, model: bytes) -> list[str]:
    """What the library makes of each chunk's ids; it drops the first marker."""
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    plain: list[str] = []
    for at in range(0, len(first) - 1, AT_ONCE):
        ends = first[at : at + AT_ONCE + 1].tolist()
        lists = [flat[a:b].tolist() for a, b in zip(ends, ends[1:])]
        plain += processor.decode(lists, num_threads=1)
    return plain
