"""Removal of repeated strings by sorting suffixes, deep after shallow.

A window is a string of LENGTH bytes. Suffixes are ordered by their first LENGTH bytes
only, and only where a window may occur twice: each window has an anchor, the string of
GRAM bytes inside it with the smallest hash, so that equal windows have equal anchors.
Windows in a row with one anchor form a segment, and only segments whose anchor occurs
elsewhere go on. Those with one anchor meet in one bucket. There, suffixes are ordered by
multikey quicksort, eight bytes at a time, to a shallow depth; groups with a longer
common prefix are ordered by blind tries, which compare each suffix with the group's
first and branch where they differ. What is equal in all LENGTH bytes is one string, and
all but its first occurrence are repeats.

A task that sees an anchor often says so, and then segments of that anchor are dealt by
the longer of the two strings beside it, GRAM + SIDE bytes that their windows also hold.
If a task sees one of these often, too, its windows are dealt by their own hash, after the
task has set aside those it has seen before. So a bucket holds a bounded number of
segments per task, whatever a string's frequency.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.functions.skew import numbered
from editflow.llm.tables import bytes_of, having, sampled, shuffle_width, stored
from editflow.llm.words import keys, mix

LENGTH = 100
GRAM = 24
SIDE = (LENGTH - GRAM) // 2  # for strings of LENGTH bytes
SHALLOW = 16
# An anchor is frequent if one task sees it this often in FLUSH bytes of text.
FREQUENT = 8
FLUSH = 32 << 20
# Bytes of text that are hashed at once.
PIECE = 1 << 18
# Texts are compressed for shuffles with a dictionary from a bounded sample of beginnings.
SAMPLE_TEXTS = 400
SAMPLE_BYTES = 4 << 10

_ANCHOR = "key long, doc long, place long"
_SEGMENT = "bucket long, doc long, start long, n int, shift int, body binary"
_COVER = "doc long, start long, n int"
_MARKER, _SINGLE, _FREQUENT = 0, 1, 2


def without_repeats(docs: DataFrame, length: int = LENGTH, letters: bool = False) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept.

    Every byte covered by a string of `length` bytes that also starts earlier, in a text
    with a smaller doc_id or in the same text, is removed; kept holds the other bytes.
    Null texts are empty. Rows with equal doc_id and text are one document, and each
    gets its result; rows with equal doc_id and different texts are ordered by a digest
    of the text. Rows without doc_id are compared with nothing and stay whole. Other
    columns are ignored. With `letters`, kept also leaves out what a cut leaves of a letter
    of several bytes, so that it is UTF-8; n_removed and n_spans stay those of the bytes.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text")
    )
    named = rows.where("doc_id is not null")
    repeated = not named.groupBy("doc_id").count().where("count > 1").isEmpty()
    if repeated:
        one = named.withColumn("digest", F.sha2("text", 256)).distinct()
        order = stored(numbered(one.select("doc_id", "digest"), ["doc_id", "digest"], "doc"), "order")
        texts = stored(one.join(order, ["doc_id", "digest"]).select("doc", "text"), "texts")
    else:
        texts = named.select(F.col("doc_id").alias("doc"), "text")
    words = dictionary(texts)
    result = cut(texts, repeats(texts, length, words), length, words, letters)
    if repeated:
        each = named.select("doc_id", F.sha2("text", 256).alias("digest"))
        result = each.join(order, ["doc_id", "digest"]).join(result, "doc").drop("doc", "digest")
    else:
        result = result.withColumnRenamed("doc", "doc_id")
    alone = rows.where("doc_id is null").select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.col("text").alias("kept"),
    )
    return result.unionByName(alone)


def repeats(texts: DataFrame, length: int = LENGTH, words: bytes = b"") -> DataFrame:
    """doc, start, n: windows at start, start + 1, ... n of them, that also start earlier."""
    width = shuffle_width(texts.sparkSession)
    anchors = texts.mapInArrow(partial(_anchors, length=length), _ANCHOR)
    anchors = anchors.repartition(width, "key").sortWithinPartitions("key", "doc", "place")
    shared = anchors.mapInArrow(_shared, _ANCHOR)
    per_doc = shared.groupBy("doc").agg(F.collect_list(F.struct("place", "key")).alias("anchors"))
    per_doc = stored(per_doc, "anchors")
    holders = having(texts, per_doc.select("doc"), "doc")
    located = packed(holders, words).join(per_doc, "doc").sortWithinPartitions("doc")
    cut_up = partial(_segments, length=length, words=words)
    segments = stored(located.mapInArrow(cut_up, _SEGMENT), "segments")
    order = partial(_sorted, length=length)

    def ordered(rows: DataFrame) -> DataFrame:
        rows = rows.repartition(width, "bucket").sortWithinPartitions("bucket", "doc", "start")
        return rows.mapInArrow(order, _SEGMENT)

    known = F.col("bucket").isNull()
    window = F.col("shift") < 0
    first = stored(ordered(segments.where(~known & ~window)), "ordered")
    windows = segments.where(~known & window).unionByName(first.where(~known))
    covers = segments.where(known).unionByName(first.where(known)).unionByName(ordered(windows))
    return covers.select("doc", "start", "n")


def cut(
    texts: DataFrame, covers: DataFrame, length: int = LENGTH, words: bytes = b"", letters: bool = False
) -> DataFrame:
    """doc, n_bytes, n_removed, n_spans, kept of every text."""
    per_doc = covers.groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("covers"))
    per_doc = stored(per_doc, "covers")
    ids = per_doc.select("doc")
    joined = packed(having(texts, ids, "doc"), words).join(per_doc, "doc")
    less = joined.mapInArrow(
        partial(_cut, length=length, words=words, letters=letters),
        "doc long, n_bytes long, n_removed long, n_spans long, kept binary",
    )
    whole = having(texts, ids, "doc", "left_anti").select(
        "doc",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.col("text").alias("kept"),
    )
    return less.unionByName(whole)


def dictionary(texts: DataFrame) -> bytes:
    beginnings = texts.select("doc", F.substring("text", 1, SAMPLE_BYTES).alias("text"))
    rows = sampled(beginnings, ["doc"], SAMPLE_TEXTS, "sample")
    samples = [bytes(r["text"]) for r in rows if r["text"]]
    try:
        return zstandard.train_dictionary(64 << 10, samples).as_bytes() if len(samples) > 50 else b""
    except zstandard.ZstdError:
        return b""


def packed(texts: DataFrame, words: bytes) -> DataFrame:
    """Texts compressed one by one, for shuffles."""
    return texts.mapInArrow(partial(_pack, words=words), "doc long, packed binary")


def _dictionary(words: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(words) if words else None


def _pack(batches: Iterable[pa.RecordBatch], words: bytes) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(words))
    for batch in batches:
        small = [press.compress(t.as_buffer()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(small, pa.binary())], ["doc", "packed"])


def _unpacked(press: zstandard.ZstdDecompressor, value: pa.Scalar) -> bytes:
    return press.decompress(value.as_buffer())


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number; zeros follow the end."""
    whole = np.zeros(-(-(len(data) + 8) // 8) * 8 + 8, np.uint8)
    whole[: len(data)] = data
    out = np.empty(len(whole) - 8, np.uint64)
    for shift in range(8):
        part = whole[shift : shift + len(out)].view(">u8")
        out[shift::8] = part
    return out[: len(data)]


def _chosen(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window start: the position of its anchor; and the hashes of all grams."""
    grams = length - GRAM + 1
    eight = words_at(data)
    factor = keys(GRAM // 8, 5)
    n = len(data) - GRAM + 1
    total = np.zeros(n, np.uint64)
    for j in range(GRAM // 8):
        total += mix(eight[8 * j : 8 * j + n] * factor[j])
    hashes = mix(total)
    least = (hashes & ~np.uint64((1 << 20) - 1)) | np.arange(n, dtype=np.uint64)
    size = 1
    while 2 * size <= grams:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if grams > size:
        least = np.minimum(least[: len(least) - (grams - size)], least[grams - size :])
    return (least & np.uint64((1 << 20) - 1)).astype(np.int64), hashes


def segments_of(
    data: np.ndarray, starts: np.ndarray, length: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Segments of texts laid end to end: text, first window, windows, anchor's place in it, hash."""
    low = 0
    while low < len(data):
        high = min(len(data), low + PIECE + length - 1)
        if high - low >= length:
            anchor, hashes = _chosen(data[low:high], length)
            at = np.arange(low, low + len(anchor))
            text = np.searchsorted(starts, at, "right") - 1
            valid = at + length <= starts[text + 1]
            first = valid.copy()
            first[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
            begin = np.flatnonzero(first)
            if len(begin):
                count = np.add.reduceat(valid.astype(np.int64), begin)
                where = anchor[begin]
                yield (
                    text[begin],
                    at[begin] - starts[text[begin]],
                    count,
                    where + low - at[begin],
                    hashes[where].view(np.int64),
                )
        low += PIECE


def _anchors(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """key, doc, place of each segment; a frequent anchor gives a marker and is spread by text."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def out() -> pa.RecordBatch:
        key, doc, place = (np.concatenate(c) for c in zip(*held))
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        often = (count >= FREQUENT)[back]
        marks = np.unique(key[often])
        spread = mix(key.view(np.uint64) ^ mix(doc.view(np.uint64))).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([np.where(often, spread, key), marks])),
                pa.array(np.concatenate([doc, np.zeros(len(marks), np.int64)])),
                pa.array(np.concatenate([place | np.where(often, _FREQUENT, _SINGLE), np.full(len(marks), _MARKER)])),
            ],
            ["key", "doc", "place"],
        )

    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        data, starts = bytes_of(batch.column(1))
        for text, start, count, shift, hashed in segments_of(data, starts, length):
            held.append((hashed, ids[text], (start << 18) | (shift << 10) | (count << 2)))
        size += len(data)
        if size >= FLUSH and held:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments whose anchor occurs twice, or is frequent somewhere; batches are sorted by key."""
    kept: tuple[np.ndarray, ...] | None = None

    def out(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        key, doc, place = rows
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        count = np.diff(np.append(first, len(key)))
        kind = place & 3
        marked = np.logical_or.reduceat(kind != _SINGLE, first)
        often = np.repeat(marked, count)
        good = (often | (np.repeat(count, count) > 1)) & (kind != _MARKER)
        place = np.where(often, (place & ~3) | _FREQUENT, place)
        return pa.RecordBatch.from_arrays(
            [pa.array(key[good]), pa.array(doc[good]), pa.array(place[good])], ["key", "doc", "place"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = tuple(c.to_numpy() for c in batch.columns)
        if kept is not None:
            rows = tuple(np.concatenate(pair) for pair in zip(kept, rows))
        last = int(np.searchsorted(rows[0], rows[0][-1], "left"))
        if last:
            yield out(tuple(c[:last] for c in rows))
        kept = tuple(c[last:] for c in rows)
    if kept is not None:
        yield out(kept)


def _segments(
    batches: Iterable[pa.RecordBatch], length: int, words: bytes
) -> Iterator[pa.RecordBatch]:
    """Bodies of segments under their anchor, or under a longer string beside a frequent one.

    Texts come in order, so what this task has seen before is a repeat: bucket is null.
    Windows of what is still frequent stand alone under their own hash, with shift -1, and
    a row without body marks the bucket they left.
    """
    press = zstandard.ZstdDecompressor(_dictionary(words))
    seen: set[bytes] = set()
    out: list[tuple] = []
    sides: list[tuple] = []
    size = 0

    def add(rows: list[tuple], bucket: int, doc: int, start: int, n: int, shift: int, body: bytes) -> None:
        digest = hashlib.blake2b(body + shift.to_bytes(2, "little", signed=True), digest_size=16).digest()
        if digest in seen:
            out.append((None, doc, start, n, 0, None))
            return
        seen.add(digest)
        rows.append((bucket, doc, start, n, shift, body))

    def split_frequent() -> None:
        count = Counter(row[0] for row in sides)
        for row in sides:
            if count[row[0]] < FREQUENT:
                out.append(row)
            else:
                for one in _windows(*row, length):
                    add(out, *one)
        out.extend((key, _FIRST, 0, 0, 0, None) for key, n in count.items() if n >= FREQUENT)
        sides.clear()

    for batch in batches:
        docs = batch.column(0).to_pylist()
        for row, doc in enumerate(docs):
            text = _unpacked(press, batch.column(1)[row])
            listed = batch.column(2)[row].values
            place, key = (np.asarray(listed.field(i)) for i in (0, 1))
            order = np.argsort(place)
            place, key = place[order], key[order]
            for kind, bucket, start, shift, count in zip(
                (place & 3).tolist(),
                key.tolist(),
                (place >> 18).tolist(),
                ((place >> 10) & 255).tolist(),
                ((place >> 2) & 255).tolist(),
            ):
                if kind == _SINGLE:
                    add(out, bucket, doc, start, count, shift, text[start : start + count + length - 1])
                    continue
                at = start + shift
                # Windows with SIDE bytes before the anchor, and those with as many after it.
                left = min(count, max(0, shift - SIDE + 1))
                for low, high, beside in (
                    (0, left, text[at - SIDE : at + GRAM] if left else b""),
                    (left, count, text[at : at + GRAM + SIDE]),
                ):
                    if high > low:
                        body = text[start + low : start + high + length - 1]
                        add(sides, _key(beside), doc, start + low, high - low, shift - low, body)
                        size += len(body)
            if len(seen) > 1_000_000:
                seen.clear()
            if size >= FLUSH:
                split_frequent()
                size = 0
            if len(out) >= 20_000:
                yield _batch(out)
                out = []
    split_frequent()
    if out:
        yield _batch(out)


_FIRST = -(1 << 63)


def _key(string: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(string, digest_size=8).digest(), "little", signed=True)


def _windows(
    bucket: int, doc: int, start: int, n: int, shift: int, body: bytes, length: int
) -> Iterator[tuple]:
    for i in range(n):
        window = body[i : i + length]
        yield _key(window), doc, start + i, 1, -1, window


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*_merged(rows)), kinds)],
        ["bucket", "doc", "start", "n", "shift", "body"],
    )


def _merged(rows: list[tuple]) -> list[tuple]:
    """Adjacent repeats as one row."""
    out: list[tuple] = []
    for row in rows:
        if row[0] is None and out:
            last = out[-1]
            if last[0] is None and last[1] == row[1] and last[2] + last[3] == row[2]:
                out[-1] = (None, row[1], last[2], last[3] + row[3], 0, None)
                continue
        out.append(row)
    return out


def _sorted(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Repeats (bucket null) of whole buckets; windows of marked buckets, which are to be dealt anew."""
    kept: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if kept is not None:
            rows = pa.concat_tables([kept, rows]).combine_chunks()
        bucket = rows["bucket"].to_numpy()
        last = int(np.searchsorted(bucket, bucket[-1], "left"))
        if last:
            yield from _order(rows.slice(0, last), length)
        kept = rows.slice(last)
    if kept is not None:
        yield from _order(kept.combine_chunks(), length)


def _order(rows: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    """Rows are whole buckets, in the order of bucket, text and place."""
    bucket, doc, start, n, shift = (rows[c].to_numpy() for c in ("bucket", "doc", "start", "n", "shift"))
    first = np.append(True, bucket[1:] != bucket[:-1])
    number = np.cumsum(first) - 1
    marked = (n[first] == 0)[number]
    out: list[tuple] = []
    if marked.any():
        bodies = rows["body"].take(pa.array(np.flatnonzero(marked))).to_pylist()
        for row, body in zip(np.flatnonzero(marked).tolist(), bodies):
            if n[row]:
                out.extend(_windows(0, int(doc[row]), int(start[row]), int(n[row]), 0, body, length))
            if len(out) >= 20_000:
                yield _batch(out)
                out = []
    use = np.flatnonzero((np.bincount(number)[number] > 1) & ~marked)
    rows = rows.take(pa.array(use)).combine_chunks()
    number, doc, start, n = (c[use] for c in (number, doc, start, n))
    shift = np.maximum(shift[use], 0)
    # Equal segments first: all windows of the later ones are repeats.
    alike: set[tuple] = set()
    fresh = np.ones(len(use), bool)
    for row, body in enumerate(rows["body"].to_pylist()):
        mark = (number[row], shift[row], body)
        if mark in alike:
            fresh[row] = False
            out.append((None, int(doc[row]), int(start[row]), int(n[row]), 0, None))
        alike.add(mark)
    use = np.flatnonzero(fresh)
    use = use[np.bincount(number[use], minlength=number.max() + 1 if len(number) else 0)[number[use]] > 1]
    if len(use):
        data, starts = bytes_of(rows["body"].combine_chunks() if rows.num_rows else pa.array([], pa.binary()))
        row = np.repeat(use, n[use])
        inside = np.arange(len(row)) - np.repeat(np.cumsum(n[use]) - n[use], n[use])
        # Equal windows have their anchor at the same place.
        group = number[row] * 256 + shift[row] - inside
        repeat = repeated_suffixes(data, starts[row] + inside, group, length)
        row, inside = row[repeat], inside[repeat]
        if len(row):
            begin = np.append(True, (row[1:] != row[:-1]) | (inside[1:] != inside[:-1] + 1))
            begin = np.flatnonzero(begin)
            count = np.diff(np.append(begin, len(row)))
            out.extend(
                (None, d, s, c, 0, None)
                for d, s, c in zip(
                    doc[row[begin]].tolist(), (start[row[begin]] + inside[begin]).tolist(), count.tolist()
                )
            )
    if out:
        yield _batch(out)


def repeated_suffixes(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Indexes, ascending, of suffixes whose first `length` bytes an earlier one of the group has."""
    eight = words_at(data)
    index = np.arange(len(at))
    # Shallow: multikey quicksort, eight bytes at a time; suffixes alone in a part are in place.
    for depth in range(0, SHALLOW, 8):
        index, group = _partition(index, group, eight[at[index] + depth])
    # Deep: in a blind trie, each suffix leaves the path of the group's first one where it differs.
    depths = np.array([*range(SHALLOW, length - 7, 8), length - 8])
    found = []
    while len(index):
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        top = np.repeat(first, np.diff(np.append(first, len(index))))
        branch = np.full(len(index), len(depths))
        edge = np.zeros(len(index), np.uint64)
        for level in range(len(depths) - 1, -1, -1):
            mine = eight[at[index] + depths[level]]
            differs = mine != mine[top]
            branch[differs] = level
            edge[differs] = mine[differs]
        same = branch == len(depths)
        found.append(index[same & (np.arange(len(index)) != top)])
        index, group, branch, edge = (c[~same] for c in (index, group, branch, edge))
        index, group = _partition(index, group * (len(depths) + 1) + branch, edge)
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _partition(index: np.ndarray, group: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by group, word and index; number the parts, and leave out those of one suffix."""
    order = np.lexsort((word, group))  # stable, and index rises
    index, group, word = index[order], group[order], word[order]
    if not len(index):
        return index, group
    first = np.append(True, (group[1:] != group[:-1]) | (word[1:] != word[:-1]))
    number = np.cumsum(first) - 1
    more = np.bincount(number)[number] > 1
    return index[more], number[more]


def _whole_letters(piece: bytes) -> bytes:
    """A piece of UTF-8 without the parts of letters at its ends."""
    return piece.decode("utf-8", "ignore").encode()


def _cut(
    batches: Iterable[pa.RecordBatch], length: int, words: bytes, letters: bool
) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdDecompressor(_dictionary(words))
    whole = _whole_letters if letters else bytes
    for batch in batches:
        out: list[tuple] = []
        for row in range(batch.num_rows):
            text = _unpacked(press, batch.column(1)[row])
            covers = batch.column(2)[row]
            pieces, end, begin, removed, spans = [], 0, -1, 0, 0
            if covers.is_valid:
                listed = covers.values
                start, n = (np.asarray(listed.field(i)).astype(np.int64) for i in (0, 1))
                order = np.argsort(start, kind="stable")
                for low, high in zip(start[order].tolist(), (start + n + length - 1)[order].tolist()):
                    if begin < 0 or low > end:
                        pieces.append(whole(text[end:low]))
                        spans += 1
                        removed += high - low
                        begin, end = low, high
                    elif high > end:
                        removed += high - end
                        end = high
            pieces.append(whole(text[end:]))
            out.append((len(text), removed, spans, b"".join(pieces)))
        columns = list(zip(*out)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())],
            ["doc", "n_bytes", "n_removed", "n_spans", "kept"],
        )
