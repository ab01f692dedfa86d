"""Benchmark items inside training texts, by BM25 retrieval and a check of the overlap.

Items are cut into units of at most UNIT words, and an inverted index keeps per term the
units it occurs in with their BM25 impact, as a share of the unit's own full score. Units
are numbered and grouped in blocks; per term and block the largest impact is stored.
Every training text is cut into passages of two cells of UNIT words, one cell apart, so
that each run of UNIT words lies inside a passage. Each passage is a query: as in
block-max WAND, the sum of its terms' largest impacts, first over the whole index and then
per block, bounds every score in a block, and blocks that can't reach the threshold are
skipped. In the others the scores are computed from the postings, and all units above
the threshold are retrieved. Their items are verified on the words themselves.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.llm.tables import bytes_of, spans, stored
from editflow.llm.words import CHUNK, split, word_hashes

UNIT = 64
K1, B = 1.2, 0.75
# Units with at least this share of their own BM25 score are retrieved.
THRESHOLD = 0.5
SHINGLE = 5
# Items with at least this share of their shingles in the text are contamination, if it also
# holds this share of the question's and of the answer's: a question with another answer isn't.
OVERLAP = 0.8
PART = 0.5
BLOCK = 16
# Text of items that one index holds; more items make more indexes, each over all texts.
INDEX_BYTES = 32 << 20

_FOUND = "doc_id long, item_id long, score double, question double, answer double, overlap double"


@dataclass
class Item:
    """An item's shingles: of the question (all but the last sentence) and of the answer."""

    item_id: int
    question: frozenset[bytes]
    answer: frozenset[bytes]


def _shingles(words: list[bytes]) -> frozenset[bytes]:
    if len(words) < SHINGLE:
        return frozenset([b" ".join(words)] if words else [])
    return frozenset(b" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1))


def item_of(item_id: int, text: bytes) -> Item:
    """Question and answer: split after the last sentence end with words on both sides."""
    words = split(text)
    ends = [i + 1 for i, w in enumerate(words[:-1]) if w[-1:] in (b".", b"?", b"!", b":")]
    cut = ends[-1] if ends else len(words)
    question, answer = _shingles(words[:cut]), _shingles(words[cut:])
    # Shingles across the cut belong to the question.
    across = _shingles(words[max(0, cut - SHINGLE + 1) : cut + SHINGLE - 1]) if cut < len(words) else frozenset()
    return Item(item_id, question | across, answer)


def bags_of(text: bytes) -> list[Counter[int]]:
    """Word hashes of each unit of an item."""
    words, bags = split(text), []
    for low in range(0, len(words), UNIT):
        part = b" ".join(words[low : low + UNIT])
        hashes, _ = word_hashes(np.frombuffer(part, np.uint8), np.array([0, len(part)]))
        bags.append(Counter(hashes.tolist()))
    return bags


@dataclass
class Statistics:
    """Number of units and of their words, and of the units that hold a term."""

    units: int
    words: int
    held: Mapping[int, int]


@dataclass
class Index:
    """Postings sorted by unit, with the largest impact per term and per term and block."""

    items: list[Item]
    terms: np.ndarray
    first: np.ndarray
    units: np.ndarray
    impacts: np.ndarray
    unit_item: np.ndarray
    term_most: np.ndarray
    block_first: np.ndarray
    blocks: np.ndarray
    block_most: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, bytes]], known: Statistics | None = None) -> Index:
        """`known` are the statistics of all units, if rows are only a part of the items."""
        items, unit_item, bags = [], [], []
        for item_id, text in rows:
            mine = bags_of(text)
            if mine:
                bags += mine
                unit_item += [len(items)] * len(mine)
                items.append(item_of(item_id, text))
        lengths = np.array([sum(b.values()) for b in bags], float)
        if known is None:
            held = Counter(t for b in bags for t in b)
            known = Statistics(len(bags), int(lengths.sum()), held)
        mean, held = known.words / max(known.units, 1), known.held
        postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for unit, bag in enumerate(bags):
            norm = K1 * (1 - B + B * lengths[unit] / mean)
            scores = {
                t: math.log(1 + (known.units - held[t] + 0.5) / (held[t] + 0.5)) * n * (K1 + 1) / (n + norm)
                for t, n in bag.items()
            }
            full = sum(scores.values())
            for t, x in scores.items():
                postings[t].append((unit, x / full))
        terms = np.array(sorted(postings), np.uint64)
        lists = [postings[int(t)] for t in terms]
        units = np.array([u for p in lists for u, _ in p], np.int64)
        impacts = np.array([x for p in lists for _, x in p], float)
        first = np.concatenate([[0], np.cumsum([len(p) for p in lists])]).astype(np.int64)
        blocks, most, block_first = [], [], [0]
        for p in lists:
            best: dict[int, float] = {}
            for u, x in p:
                best[u // BLOCK] = max(best.get(u // BLOCK, 0.0), x)
            blocks.extend(best)
            most.extend(best.values())
            block_first.append(len(blocks))
        return cls(
            items,
            terms,
            first,
            units,
            impacts,
            np.array(unit_item, np.int64),
            np.array([max(x for _, x in p) for p in lists], float),
            np.array(block_first, np.int64),
            np.array(blocks, np.int64),
            np.array(most, float),
        )

    def retrieve(self, hashes: np.ndarray, cell_of: np.ndarray, pair: np.ndarray, threshold: float):
        """(cell, unit, score) of all units above the threshold in the passage that a cell begins.

        hashes: word hashes; cell_of: their cells, ascending; pair[c]: whether cell c + 1
        is of the same text.
        """
        cells = len(pair)
        if not len(self.terms) or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == hashes
        key = np.unique(cell_of[known] * len(self.terms) + at[known])
        cell, term = key // len(self.terms), key % len(self.terms)
        # Bound of a passage over the whole index.
        alone = np.bincount(cell, self.term_most[term], cells)
        whole = alone + np.where(pair, np.append(alone[1:], 0), 0)
        live = whole >= threshold
        # Terms of a live passage, each once: from its first cell, and new ones of its second.
        inside = np.concatenate([key[live[cell]], key[(cell > 0) & np.roll(live & pair, 1)[cell]] - len(self.terms)])
        inside = np.unique(inside)
        passage, term = inside // len(self.terms), inside % len(self.terms)
        whole = np.bincount(passage, self.term_most[term], cells)
        keep = whole[passage] >= threshold
        passage, term = passage[keep], term[keep]
        # Bound per block.
        many = self.block_first[term + 1] - self.block_first[term]
        at = _ranges(self.block_first[term], many)
        blocks = int(self.blocks.max()) + 1
        spot = np.repeat(passage, many) * blocks + self.blocks[at]
        spots, where = np.unique(spot, return_inverse=True)
        bound = np.bincount(where, self.block_most[at], len(spots))
        open_spots = spots[bound >= threshold - 1e-9]
        if not len(open_spots):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        # Scores in the blocks that are left.
        keep = np.isin(passage, np.unique(open_spots // blocks))
        passage, term = passage[keep], term[keep]
        many = self.first[term + 1] - self.first[term]
        at = _ranges(self.first[term], many)
        passage = np.repeat(passage, many)
        keep = np.isin(passage * blocks + self.units[at] // BLOCK, open_spots)
        passage, at = passage[keep], at[keep]
        total = len(self.unit_item)
        hit, where = np.unique(passage * total + self.units[at], return_inverse=True)
        score = np.bincount(where, self.impacts[at], len(hit))
        good = score >= threshold
        return hit[good] // total, hit[good] % total, score[good]


def _ranges(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... many[i] numbers of each, end to end."""
    ends = np.cumsum(many)
    return np.repeat(first - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    index_bytes: int = INDEX_BYTES,
    part: float = PART,
) -> DataFrame:
    """One row per document and benchmark item that it contains.

    docs (doc_id, text) and items (item_id, text); returns doc_id, item_id, score (best
    BM25 share of a unit), question, answer and overlap: the shares of the question's,
    the answer's and all shingles of the item found in the document. Pairs with
    overlap >= `overlap`, of which the question and the answer each are found by `part` or
    more, are returned. Null and empty texts and items contain nothing and
    are contained in nothing; rows without an id are compared, too. Repeated rows give
    repeated rows. Columns besides these are ignored.

    Items larger than `index_bytes` together are dealt to several indexes, which all score by
    the statistics of all items. The result doesn't depend on it.
    """
    rows = items.select(F.col("item_id").cast("long"), F.encode("text", "UTF-8").alias("text"))
    rows = stored(rows.where(F.octet_length("text") > 0), "items")
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, math.ceil(size / index_bytes))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int").alias("shard")
    rows = rows.select("item_id", "text", dealt)
    terms = stored(_terms(rows), "terms") if shards > 1 else None
    found = None
    for shard in range(shards):
        held = sorted(((r["item_id"], bytes(r["text"])) for r in rows.where(F.col("shard") == shard).collect()), key=repr)
        index = Index.of(held, None if terms is None else _statistics(terms, shard))
        search = partial(_search, index=index, threshold=threshold, overlap=overlap, least=part)
        one = texts.mapInArrow(search, _FOUND)
        found = one if found is None else found.unionByName(one)
    return found


def _terms(rows: DataFrame) -> DataFrame:
    """term, units, words, shards: units that hold a term; of the null term all units and their words."""
    each = rows.select("text", "shard").mapInArrow(_bags, "term long, units long, words long, shard int")
    grouped = each.groupBy("term").agg(
        F.sum("units").alias("units"), F.sum("words").alias("words"), F.collect_set("shard").alias("shards")
    )
    return grouped


def _bags(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for text, shard in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            bags = bags_of(text)
            held = Counter(t for bag in bags for t in bag)
            out += [(int(np.uint64(t).astype(np.int64)), n, 0, shard) for t, n in held.items()]
            out.append((None, len(bags), sum(sum(b.values()) for b in bags), shard))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
        columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 4, kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["term", "units", "words", "shard"])


def _statistics(terms: DataFrame, shard: int) -> Statistics:
    """Of all units, for the terms of one shard: no more than its items' text holds."""
    mine = terms.where("term is not null").where(F.array_contains("shards", shard)).collect()
    whole = terms.where("term is null").first()
    held = {int(np.int64(r["term"]).astype(np.uint64)): r["units"] for r in mine}
    return Statistics(whole["units"], whole["words"], held)


def _search(
    batches: Iterable[pa.RecordBatch], index: Index, threshold: float, overlap: float, least: float
) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "item_id", "score", "question", "answer", "overlap"]
    for batch in batches:
        ids = batch.column(0)
        data, starts = bytes_of(batch.column(1))
        out: list[tuple] = []
        for low, high in spans(starts, CHUNK):
            part = data[starts[low] : starts[high]]
            hashes, counts = word_hashes(part, starts[low : high + 1] - starts[low])
            cells = -(-counts // UNIT)
            base = np.cumsum(cells) - cells
            inside = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
            cell_of = np.repeat(base, counts) + inside // UNIT
            owner = np.repeat(np.arange(len(counts)), cells)
            pair = np.append(owner[1:] == owner[:-1], False) if len(owner) else np.zeros(0, bool)
            cell, unit, score = index.retrieve(hashes, cell_of, pair, threshold)
            best: dict[tuple[int, int], float] = {}
            for row, item, x in zip(owner[cell].tolist(), index.unit_item[unit].tolist(), score.tolist()):
                best[row, item] = max(best.get((row, item), 0.0), x)
            shingled: tuple[int, frozenset[bytes]] = (-1, frozenset())
            for (row, item), x in sorted(best.items()):
                if shingled[0] != row:
                    text = part[starts[low + row] - starts[low] : starts[low + row + 1] - starts[low]]
                    shingled = (row, _shingles(split(text.tobytes())))
                checked = _verify(index.items[item], shingled[1])
                if checked[2] >= overlap and min(checked[:2]) >= least:
                    out.append((ids[low + row].as_py(), index.items[item].item_id, x, *checked))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if i < 2 else pa.float64()) for i, c in enumerate(zip(*out))],
                names=names,
            )


def _verify(item: Item, shingles: frozenset[bytes]) -> tuple[float, float, float]:
    """Shares of the question's, the answer's and all shingles; a part without words counts as found."""

    def share(part: frozenset[bytes]) -> float:
        if not part:
            return 1.0
        full = [s for s in part if s.count(b" ") == SHINGLE - 1]
        if full:
            return sum(s in shingles for s in full) / len(full)
        # Fewer words than a shingle: anywhere inside one.
        return float(all(any(b" " + p + b" " in b" " + s + b" " for s in shingles) for p in part))

    question, answer = share(item.question), share(item.answer)
    whole = item.question | item.answer
    full = any(s.count(b" ") == SHINGLE - 1 for s in whole)
    return question, answer, share(whole) if full else min(question, answer)
