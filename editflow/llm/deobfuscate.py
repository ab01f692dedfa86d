"""Words as they were meant behind leetspeak, spacing, repeated letters and junk signs.

Noisy channel: a writer's word became leetspeak, was spaced out, or had letters repeated or
junk signs added. The observed signs form a lattice of possible letters; Viterbi decoding
under a trigram model of the corpus' letters picks the likeliest reading.

The model counts the letters of any script over all texts. It grows with the corpus and
stays a table. Disguised strings are decoded once each, in blocks: a block asks the table
for the trigrams that its lattices can pass through, and is decoded from what comes back.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.llm.tables import bytes_of, runs, spans, stored

# What a sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "ø": "o",
}
# Costs, in nats, of what the channel does to a letter.
PLAIN, SWAPPED, REPEATED, DROPPED, SPLIT = 0.05, 1.0, 0.7, 2.5, 0.7
# Weight of the shorter letter group where a longer one is rare.
BACK_OFF = 5
_JUNK = "#*%&.,;:\"'()[]{}<>~^=?/\\-_!|$+@`"
_LEAD = "#*%&.,;:\"'()[]{}<>~^=?/\\-_`"
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_LETTER = re.compile(r"[^\W\d_]")
_PIECES = re.compile(r"[^\w@$!|+€(\-.*]+|[-.*]{2,}")
# Single signs that are, or may stand for, a letter, with anything else between them.
_SWAPS = "".join(x for x in LEET if not x.isalnum())
_SIGN = "(?:[^\\W_]|[" + re.escape(_SWAPS) + "])"
_BETWEEN = re.compile(f"(?:(?!{_SIGN})[\\s\\S])+")
_SPACED = re.compile(rf"(?<![^\W_]){_SIGN}(?:{_BETWEEN.pattern}{_SIGN}){{2,}}(?![^\W_])")

# A code point's kind: whether it is a letter or digit, a sign that stands for a letter, a letter.
_ALNUM, _SWAP, _IS_LETTER, _UNKNOWN = 1, 2, 4, 128
_KINDS = np.full(0x110000, _UNKNOWN, np.uint8)
_POINT = 21  # bits
_MASK = (1 << _POINT) - 1
# Bytes of the texts that are looked at together; a longer text comes alone.
BYTES = 2 << 20
# Signs that are counted at once, distinct trigrams that a task holds, strings of one block.
COUNTED, HELD, BLOCK = 1 << 21, 1_000_000, 2_000


def _kinds(points: np.ndarray) -> np.ndarray:
    found = _KINDS[points]
    if (found == _UNKNOWN).any():
        for point in np.unique(points[found == _UNKNOWN]).tolist():
            sign = chr(point)
            kind = _ALNUM * sign.isalnum() + _SWAP * (sign in _SWAPS)
            _KINDS[point] = kind + _IS_LETTER * (_LETTER.match(sign) is not None)
        found = _KINDS[points]
    return found


@dataclass
class Signs:
    """Code points of lower-case texts end to end, two line ends between, and their kinds."""

    texts: list[str]
    points: np.ndarray
    kinds: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, texts: Iterable[str | None]) -> Signs:
        low = [(text or "").lower() for text in texts]
        points = np.frombuffer("".join(t + "\n\n" for t in low).encode("utf-32-le", "replace"), np.uint32)
        starts = np.cumsum([0] + [len(t) + 2 for t in low])
        return cls(low, points, _kinds(points), starts)

    def _owners(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1

    def spaced(self) -> set[int]:
        """The texts in which _SPACED finds something: three signs alone, one after the other.

        A sign that stands for a letter without being one may touch the first and the last.
        """
        sign = (self.kinds & (_ALNUM | _SWAP)) > 0
        edges = np.flatnonzero(np.diff(sign, prepend=False, append=False))
        begin, end = edges[::2], edges[1::2]
        if len(begin) < 3:
            return set()
        one = end - begin == 1
        tail = one | ((self.kinds[end - 2] & _SWAP) > 0)
        head = one | ((self.kinds[np.minimum(begin + 1, len(sign) - 1)] & _SWAP) > 0)
        owner = self._owners(begin)
        found = tail[:-2] & one[1:-1] & head[2:] & (owner[:-2] == owner[2:])
        return set(owner[:-2][found].tolist())

    def tripled(self) -> set[int]:
        """The texts in which a letter stands three times in a row."""
        same = self.points[1:] == self.points[:-1]
        places = np.flatnonzero(same[1:] & same[:-1] & ((self.kinds[2:] & _IS_LETTER) > 0))
        return set(self._owners(places).tolist())

    def trigrams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Packed trigrams of letters and their counts; 0 is what lies between words."""
        codes = np.where(self.kinds & _IS_LETTER, self.points, 0).astype(np.int64)
        codes = np.append([0, 0], codes)
        for low in range(0, len(codes) - 2, COUNTED):
            part = codes[low : low + COUNTED + 2]
            seen = np.zeros(len(_KINDS), bool)
            seen[part] = True
            ids = np.flatnonzero(seen)
            place = np.zeros(len(_KINDS), np.int64)
            place[ids] = np.arange(len(ids))
            small, n = place[part], len(ids)
            # Only what ends in a letter, or the end of a word.
            kept = (part[2:] > 0) | (part[1:-1] > 0)
            cells = ((small[:-2] * n + small[1:-1]) * n + small[2:])[kept]
            if n**3 <= 1 << 24:
                counts = np.bincount(cells, minlength=n**3)
                cells = np.flatnonzero(counts)
                counts = counts[cells]
            else:
                cells, counts = np.unique(cells, return_counts=True)
            yield pack(ids[cells // n // n], ids[cells // n % n], ids[cells % n]), counts


def pack(a, b, c):
    return a << 2 * _POINT | b << _POINT | c


def parts(text: str, spaced: bool, tripled: bool) -> tuple[set[str], set[str]]:
    """Words that a lower-case text shows without surrounding signs, and the strings to decode in it."""
    tokens = set(text.split())
    words = {token for token in tokens if token.isalpha()}
    strings: set[str] = set()
    if tripled:
        for word in words:
            if _TRIPLE.search(word):
                strings.update(p for p in _PIECES.split(word) if p)
    for token in tokens - words:
        core = token.rstrip(_JUNK).lstrip(_LEAD)
        if not core:
            continue
        words.add(core)
        if _TRIPLE.search(core) if core.isalpha() else _LETTER.search(core):
            strings.update(p for p in _PIECES.split(core) if p)
    if spaced:
        strings.update(_BETWEEN.sub(" ", found.group()) for found in _SPACED.finditer(text))
    return words, strings


def both(reading: str) -> list[str]:
    """The words of a reading, and all of them as one word."""
    words = reading.split()
    return [*words, "".join(words)] if len(words) > 1 else words


def _options(sign: str) -> list[tuple[str, float]]:
    letters = [(sign, PLAIN)] if _LETTER.match(sign) else []
    return letters + [(x, SWAPPED) for x in LEET.get(sign, "")]


State = tuple[int, int, str]


def _steps(state: State, sign: str, letters: list[tuple[str, float]]) -> Iterator[tuple[State, float, str, int]]:
    """Ways on from a state: the next one, the channel's price, what is read, and the letter that is scored or -1."""
    a, b, last = state
    for x, price in letters:
        yield (b, ord(x), x), price, x, ord(x)
        if x == last:
            yield state, price + REPEATED, "", -1
    if not letters or sign in LEET:
        yield state, SPLIT if not letters else DROPPED, "", -1
    if not letters and b:
        yield (b, 0, ""), 0.0, " ", 0


def passed(observed: str) -> set[tuple[int, int, int]]:
    """The trigrams that readings of a string can pass through."""
    states: set[State] = {(0, 0, "")}
    found: set[tuple[int, int, int]] = set()
    for sign in observed:
        letters = _options(sign)
        after: set[State] = set()
        for state in states:
            for new, _, _, scored in _steps(state, sign, letters):
                after.add(new)
                if scored >= 0:
                    found.add((state[0], state[1], scored))
        states = after
    return found | {(a, b, 0) for a, b, _ in states if b}


def decode(observed: str, cost: Callable[[int, int, int], float]) -> str:
    """The likeliest reading of observed signs; a space in it parts words.

    States are the last two letters and whether the last sign was a letter that may repeat;
    each sign gives a letter, repeats the last, parts words, or is junk. All states are kept,
    each with a pointer to the reading that it goes on from, so the result is exact: no
    reading is cheaper. Of equally cheap ones the first in order of letters is taken.
    """
    states: dict[State, tuple[float, tuple | None]] = {(0, 0, ""): (0.0, None)}
    for sign in observed:
        letters = _options(sign)
        after: dict[State, tuple[float, tuple | None]] = {}
        for state, (price, path) in states.items():
            for new, channel, read, scored in _steps(state, sign, letters):
                total = price + channel + (cost(state[0], state[1], scored) if scored >= 0 else 0.0)
                if new not in after or total < after[new][0]:
                    after[new] = (total, (path, read) if read else path)
        states = after
    ends = [(price + (cost(a, b, 0) if b else 0.0), path) for (a, b, _), (price, path) in states.items()]
    least = min(price for price, _ in ends)
    return min(_read(path) for price, path in ends if price == least)


def _read(path: tuple | None) -> str:
    out = []
    while path is not None:
        path, sign = path
        out.append(sign)
    return "".join(reversed(out)).strip()


# Which sums of the trigram counts a key of the table names: all three letters, the last two,
# the last, and what stands before the last: two letters, one.
TRI, BI, UNI, BEFORE_TRI, BEFORE_BI = 3, 2, 1, 5, 4


@dataclass
class Letters:
    """Cost of a letter after two others, interpolated from groups of three, two and one."""

    counts: dict[tuple[int, int], int]
    total: int
    alphabet: int
    known: dict[tuple[int, int, int], float] = field(default_factory=dict)

    @staticmethod
    def keys(a: int, b: int, c: int) -> tuple[tuple[int, int], ...]:
        bi = b << _POINT | c
        return (TRI, pack(a, b, c)), (BI, bi), (UNI, c), (BEFORE_TRI, a << _POINT | b), (BEFORE_BI, b)

    def __call__(self, a: int, b: int, c: int) -> float:
        price = self.known.get((a, b, c))
        if price is None:
            tri, bi, uni, before_tri, before_bi = (self.counts.get(key, 0) for key in self.keys(a, b, c))
            first = (uni + 1) / (self.total + self.alphabet)
            second = (bi + BACK_OFF * first) / (before_bi + BACK_OFF)
            price = -math.log((tri + BACK_OFF * second) / (before_tri + BACK_OFF))
            self.known[a, b, c] = price
        return price


def survey(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Over all texts of docs: trigrams (gram, count) and distinct disguised strings (string)."""
    rows = docs.select(F.col("text").cast("string")).mapInArrow(_survey, "gram long, string string, count long")
    found = stored(rows.groupBy("gram", "string").agg(F.sum("count").alias("count")), "survey")
    return found.where("gram is not null").drop("string"), found.where("string is not null").select("string")


def _survey(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams, counts, size = [], [], 0
    strings: set[str] = set()

    def out() -> Iterator[pa.RecordBatch]:
        if grams:
            keys, at = np.unique(np.concatenate(grams), return_inverse=True)
            yield _rows(keys.tolist(), [None] * len(keys), np.bincount(at, np.concatenate(counts)).astype(np.int64))
        if strings:
            yield _rows([None] * len(strings), sorted(strings), np.ones(len(strings), np.int64))

    for batch in batches:
        for low, high in spans(bytes_of(batch.column(0))[1], BYTES):
            signs = Signs.of(batch.column(0).slice(low, high - low).to_pylist())
            for keys, many in signs.trigrams():
                grams.append(keys)
                counts.append(many)
                size += len(keys)
            spaced, tripled = signs.spaced(), signs.tripled()
            for i, text in enumerate(signs.texts):
                strings |= parts(text, i in spaced, i in tripled)[1]
            if size + len(strings) > HELD:
                yield from out()
                grams, counts, size, strings = [], [], 0, set()
    yield from out()


def _rows(grams: list, strings: list, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(grams, pa.int64()), pa.array(strings, pa.string()), pa.array(counts)], ["gram", "string", "count"]
    )


def gram_table(trigrams: DataFrame) -> DataFrame:
    """kind, key, count: all sums of trigram counts that the model asks for."""
    gram = F.col("gram")
    kinds = {
        TRI: gram, BI: gram.bitwiseAND(F.lit((1 << 2 * _POINT) - 1)), UNI: gram.bitwiseAND(F.lit(_MASK)),
        BEFORE_TRI: F.shiftright(gram, _POINT), BEFORE_BI: F.shiftright(gram, _POINT).bitwiseAND(F.lit(_MASK)),
    }
    keys = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), key.alias("key")) for k, key in kinds.items()]))
    each = trigrams.select(keys.alias("of"), "count")
    return stored(each.groupBy("of.kind", "of.key").agg(F.sum("count").alias("count")), "grams")


def readings(strings: DataFrame, trigrams: DataFrame) -> DataFrame:
    """string, reading: each distinct string (a stored table) with its likeliest reading."""
    grams = gram_table(trigrams)
    last = grams.where(F.col("kind") == UNI)
    total, alphabet = last.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    width = max(1, strings.count() // BLOCK)
    blocks = strings.withColumn("block", F.pmod(F.xxhash64("string"), F.lit(width)))
    asked = blocks.select("block", "string").repartition(width, "block").sortWithinPartitions("block")
    asked = asked.mapInArrow(_asked, "block long, kind int, key long")
    answers = asked.join(grams, ["kind", "key"])

    def block(held: pa.Table, found: pa.Table) -> pa.Table:
        keys = zip(found["kind"].to_pylist(), found["key"].to_pylist())
        letters = Letters(dict(zip(keys, found["count"].to_pylist())), total, alphabet + 1)
        texts = held["string"].to_pylist()
        return pa.table({"string": texts, "reading": pa.array([decode(t, letters) for t in texts], pa.string())})

    out = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(block, "string string, reading string")
    return stored(out, "readings")


def _asked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys that a block's lattices ask for, each once."""
    keys: set[tuple[int, int]] = set()
    block = None
    for (number,), piece, fresh in runs(batches, ["block"]):
        if fresh and keys:
            yield _keys(block, keys)
            keys = set()
        block = number
        for text in piece.column(piece.schema.get_field_index("string")).to_pylist():
            for gram in passed(text):
                keys.update(Letters.keys(*gram))
    if keys:
        yield _keys(block, keys)


def _keys(block: int, keys: set[tuple[int, int]]) -> pa.RecordBatch:
    kinds, packed = zip(*keys)
    return pa.RecordBatch.from_arrays(
        [pa.array([block] * len(kinds), pa.int64()), pa.array(kinds, pa.int32()), pa.array(packed, pa.int64())],
        ["block", "kind", "key"],
    )
