"""Near copies of vectors by randomly rotated binary codes with correction factors.

Vectors are scaled to length 1 and belong to the cell of their nearest centre. Inside a
cell, the direction from the centre to a vector is rotated at random and kept as one
sign per dimension, with two factors: the distance to the centre, and the inner product
of the direction and its code. Dividing by the latter makes the estimate of an inner
product with any query direction unbiased, with an error bound from the same factor.

Every vector asks the cells of its PROBES nearest centres. Pairs whose upper confidence
bound stays below the threshold are left out; all others are computed again exactly, in
double precision. Cells meet in blocks, and a block returns counts per vector and a
forest of links, never its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.llm.graph import components
from editflow.llm.tables import runs, sampled, shuffle_width, stored

THRESHOLD = 0.9
# Centres come from a sample of at most SAMPLE vectors; every vector is indexed.
SAMPLE = 16_384
SAMPLE_BYTES = 32 << 20
PER_CELL = 128
CELLS = 1_024
PROBES = 8
# Confidence bounds are this many standard errors wide on each side.
ERRORS = 4.0
BLOCK = 1_024
SEED = 10

_UNIT = "vec_id long, dims int, vector binary, key binary"


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    probes: int = PROBES,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of vectors (vec_id, embedding): vec_id, n_links, component_id, kept.

    n_links counts the other vectors with cosine >= threshold, component_id is the
    smallest vec_id reachable over links, kept says that it is the vector's own. Equal
    vectors are one node of the search and link with each other. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, nor do vectors
    of different length. Rows that share a vec_id and differ are separate vectors with
    one id. A row without vec_id links with nothing: component_id null, kept true. Other
    columns are ignored. No link is below the threshold; a link is missed only if
    neither end asks the other's cell, or by the confidence bound.
    """
    units = stored(
        vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
            _scale, _UNIT
        ),
        "units",
    )
    valid = units.where("vec_id is not null and key is not null")
    nodes = valid.groupBy("dims", "key").agg(
        F.min(F.struct("vec_id", "vector")).alias("least"), F.count("*").alias("copies")
    )
    nodes = stored(
        nodes.select("dims", "key", F.col("least.vec_id").alias("id"), "least.vector", "copies"),
        "vectors",
    )
    links = None
    for (dims,) in sorted(nodes.select("dims").distinct().collect()):
        found = _links(nodes.where(F.col("dims") == dims), threshold, sample, probes, seed)
        links = found if links is None else links.unionByName(found)
    if links is None:
        links = nodes.select(F.col("id"), F.lit(0).cast("long").alias("links"), F.col("id").alias("root")).limit(0)
    links = stored(links, "vector-links")
    reached = components(links, "id", "root").withColumnRenamed("node", "id")
    counts = links.groupBy("id").agg(F.sum("links").alias("links"))
    known = nodes.join(counts, "id", "left").join(reached, "id", "left")
    known = known.select(
        "key",
        "dims",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component"),
    )
    rows = units.select("vec_id", "dims", "key").join(known, ["dims", "key"], "left")
    rows = rows.withColumn(
        "component_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    )
    count = F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0)))
    return rows.select(
        "vec_id",
        count.cast("long").alias("n_links"),
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _scale(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of length 1 as doubles, with a digest; key is null if a vector can't link."""
    schema = pa.schema([("vec_id", pa.int64()), ("dims", pa.int32()), ("vector", pa.binary()), ("key", pa.binary())])
    for batch in batches:
        dims, units, digests = [], [], []
        for row in batch.column(1):
            values = None
            if row.is_valid and len(row.values) and row.values.null_count == 0:
                values = row.values.to_numpy(zero_copy_only=False).astype(np.float64)
                top = np.abs(values).max()
                if np.isfinite(top) and top > 0:
                    values = values / top
                    values = values / np.sqrt(values @ values)
                else:
                    values = None
            dims.append(None if values is None else len(values))
            units.append(None if values is None else values.tobytes())
            digests.append(None if values is None else hashlib.blake2b(values.tobytes(), digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(dims, pa.int32()), pa.array(units, pa.binary()), pa.array(digests, pa.binary())],
            schema=schema,
        )


def _links(nodes: DataFrame, threshold: float, sample: int, probes: int, seed: int) -> DataFrame:
    centres = _centres(nodes, sample, seed)
    placed = stored(
        nodes.select("id", "vector", "copies").mapInArrow(
            partial(_place, centres=centres, probes=probes, seed=seed),
            "cell int, member boolean, id long, copies long, home int, asks array<int>, vector binary, "
            "code binary, reach double, factor double",
        ),
        "placed",
    )
    sizes = placed.groupBy("cell").agg(
        F.ceil(F.count_if("member") / BLOCK).cast("int").alias("held"),
        F.ceil(F.count_if(~F.col("member")) / BLOCK).cast("int").alias("asking"),
    )
    sizes = sizes.where("held > 0")
    rows = placed.join(sizes, "cell")
    own = F.when(F.col("member"), F.pmod(F.xxhash64("id"), "held")).otherwise(
        F.pmod(F.xxhash64("id"), "asking")
    )
    others = F.sequence(F.lit(0), F.when(F.col("member"), F.col("asking")).otherwise(F.col("held")) - 1)
    rows = rows.where("asking > 0").withColumn("own", own.cast("int")).withColumn("other", F.explode(others))
    rows = rows.withColumns(
        {
            "i": F.when(F.col("member"), F.col("own")).otherwise(F.col("other")),
            "j": F.when(F.col("member"), F.col("other")).otherwise(F.col("own")),
        }
    ).drop("own", "other", "held", "asking")
    group = ["cell", "i", "j"]
    rows = rows.repartition(shuffle_width(nodes.sparkSession), *group)
    rows = rows.sortWithinPartitions(*group, F.col("member").desc(), "id")
    return rows.mapInArrow(
        partial(_meet, centres=centres, threshold=threshold, seed=seed), "id long, links long, root long"
    )


def _centres(nodes: DataFrame, sample: int, seed: int) -> np.ndarray:
    """Centres of a bounded sample, by a few rounds of k-means on the sphere."""
    dims = nodes.select("vector").first()["vector"]
    chosen = sampled(nodes.select("key", "vector"), ["key"], min(sample, SAMPLE_BYTES // len(dims)), "sample")
    points = np.array([np.frombuffer(row.vector) for row in chosen])
    total = nodes.count()
    count = int(min(max(1, total // PER_CELL), CELLS, max(1, len(points) // 4)))
    centres = points[np.random.default_rng(seed).permutation(len(points))[:count]]
    for _ in range(6):
        near = (points @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        length = np.linalg.norm(sums, axis=1)
        full = length > 1e-9
        centres = np.where(full[:, None], sums / np.where(full, length, 1)[:, None], centres)
    return centres


def rotation(dims: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, always the same for a seed."""
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))[0]


def encode(offsets: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sign bits of rotated directions, lengths, and inner products of direction and code."""
    reach = np.linalg.norm(offsets, axis=1)
    directions = (offsets / np.where(reach > 0, reach, 1)[:, None]) @ turn
    factor = np.abs(directions).sum(1) / np.sqrt(offsets.shape[1])
    return np.packbits(directions >= 0, axis=1), reach, factor


def estimate(
    codes: np.ndarray, factor: np.ndarray, directions: np.ndarray, errors: float = ERRORS
) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased inner products of coded (rows) and rotated query directions (columns), and bounds."""
    dims = directions.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dims).astype(np.float64) * 2 - 1
    safe = np.where(factor > 0, factor, 1)[:, None]
    guess = (signs @ directions.T) / np.sqrt(dims) / safe
    spread = np.sqrt(np.maximum(0, 1 - safe**2)) / safe / np.sqrt(max(dims - 1, 1))
    return guess, np.where(factor[:, None] > 0, errors * spread, 2.0)


def _place(
    batches: Iterable[pa.RecordBatch], centres: np.ndarray, probes: int, seed: int
) -> Iterator[pa.RecordBatch]:
    """A member row in the home cell and a question for each probed cell."""
    turn = rotation(centres.shape[1], seed)
    probes = min(probes, len(centres))
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, copies = batch.column("id"), batch.column("copies")
        raw = batch.column("vector")
        units = np.array([np.frombuffer(v.as_py()) for v in raw])
        order = np.argsort(-(units @ centres.T), axis=1, kind="stable")[:, :probes]
        home = order[:, 0]
        codes, reach, factor = encode(units - centres[home], turn)
        n = len(units)
        rows = np.concatenate([np.arange(n), np.repeat(np.arange(n), probes)])
        member = np.arange(len(rows)) < n
        take = pa.array(rows)
        blank = [None] * (len(rows) - n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([home, order.ravel()]).astype(np.int32)),
                pa.array(member),
                ids.take(take),
                copies.take(take),
                pa.array(home[rows].astype(np.int32)),
                pa.array([order[r].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                raw.take(take),
                pa.array([c.tobytes() for c in codes] + blank, pa.binary()),
                pa.array(list(reach) + blank, pa.float64()),
                pa.array(list(factor) + blank, pa.float64()),
            ],
            names=["cell", "member", "id", "copies", "home", "asks", "vector", "code", "reach", "factor"],
        )


def _meet(
    batches: Iterable[pa.RecordBatch], centres: np.ndarray, threshold: float, seed: int
) -> Iterator[pa.RecordBatch]:
    turn = rotation(centres.shape[1], seed)
    held: list[pa.RecordBatch] = []
    cell = -1
    for key, piece, fresh in runs(batches, ["cell", "i", "j"]):
        if fresh and held:
            yield from _block(held, centres[cell], turn, threshold)
            held = []
        cell = key[0]
        held.append(piece)
    if held:
        yield from _block(held, centres[cell], turn, threshold)


def _block(
    held: list[pa.RecordBatch], centre: np.ndarray, turn: np.ndarray, threshold: float
) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(held).combine_chunks()
    member = rows["member"].to_numpy()
    m, q = np.flatnonzero(member), np.flatnonzero(~member)
    if not len(m) or not len(q):
        return
    ids, copies, home = (rows[c].to_numpy() for c in ("id", "copies", "home"))
    vectors = [v.as_py() for v in rows["vector"]]
    units = np.array([np.frombuffer(v) for v in vectors])
    asks = rows["asks"].to_pylist()
    codes = np.array([np.frombuffer(rows["code"][int(r)].as_py(), np.uint8) for r in m])
    reach = rows["reach"].to_numpy()[m]
    factor = rows["factor"].to_numpy()[m]
    offsets = units[q] - centre
    length = np.linalg.norm(offsets, axis=1)
    directions = (offsets / np.where(length > 0, length, 1)[:, None]) @ turn
    guess, bound = estimate(codes, factor, directions)
    # The inner product of two vectors of length 1, from distances to the centre and the angle there.
    gap = reach[:, None] ** 2 + length[None, :] ** 2
    best = 1 - 0.5 * (gap - 2 * reach[:, None] * length[None, :] * np.minimum(1, guess + bound))
    maybe = best >= threshold - 1e-9
    maybe &= ids[m][:, None] != ids[q][None, :]
    x, y = np.nonzero(maybe)
    if not len(x):
        return
    sure = np.empty(len(x), bool)
    for low in range(0, len(x), 1 << 16):
        part = slice(low, low + (1 << 16))
        exact = np.einsum("ij,ij->i", units[m[x[part]]], units[q[y[part]]])
        sure[part] = exact >= threshold
    # Both directions of a pair may be found: then the question of the smaller id counts.
    left, right = m[x[sure]], q[y[sure]]
    asked = {r: set(asks[r]) for r in np.unique(left).tolist()}
    back = np.fromiter((int(home[b]) in asked[a] for a, b in zip(left.tolist(), right.tolist())), bool, len(left))
    once = ~back | (ids[right] < ids[left])
    left, right = left[once], right[once]
    if not len(left):
        return
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, left, copies[right])
    np.add.at(links, right, copies[left])
    root = ids.copy()
    while True:
        before = root.copy()
        least = np.minimum(root[left], root[right])
        np.minimum.at(root, left, least)
        np.minimum.at(root, right, least)
        if (before == root).all():
            break
    seen = np.flatnonzero(links)
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids[seen]), pa.array(links[seen]), pa.array(root[seen])], ["id", "links", "root"]
    )
