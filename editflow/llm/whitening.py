"""Whitening of embeddings: centred, turned to their principal components, and scaled to variance 1.

Sums and centred products are added up in every task and combined over all tasks; what
reaches the driver is one number per dimension, or per pair of dimensions. There the
covariance is brought to tridiagonal form by Householder reflections; Sturm counts bisect
its leading eigenvalues; inverse iteration gives their vectors, and vectors of clustered
eigenvalues are made orthogonal to each other. The components then go to all vectors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.llm.tables import stored

COMPONENTS = 16
# An entry c counts as floor(SCALE * c) + SHIFT. Inside, the shift is left out: it cancels.
SCALE = 64
SHIFT = 1_000_000
_EDGE = 1 << 62
_LIMIT = (1 << 63) - 1
# A direction with less than this share of the greatest variance is rounding, not a component.
LEAST = 1e-13
# Eigenvalues closer than this share of the matrix' norm are a cluster.
CLUSTER = 1e-3
# Vectors are worked on so many at once.
ROWS = 4_096

_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Whitening:
    """What all tasks need: bounded by the number of dimensions times that of components."""

    n: int
    sums: list[int]  # exact, without the shift
    values: np.ndarray
    components: np.ndarray  # one row each
    trace: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])  # true division of integers rounds once

    @property
    def map(self) -> np.ndarray:
        return self.components / np.sqrt(self.values)[:, None]


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row of vectors (vec_id, embedding) and component (see _OUT).

    Rows whose vector is null or holds null or non-finite entries are dropped. Entries
    become whole numbers, floor(64 c) + 1000000, that saturate beyond 2 ** 62. The fit takes
    each distinct vector once; mean, covariance and identity_error are over it. Components
    are numbered from 1 by falling eigenvalue; their greatest entry is positive. Directions
    without variance are no components, so there are fewer than asked for if the vectors
    have fewer dimensions or lie in a smaller space, and no rows at all if only one distinct
    vector remains. Vectors of different length are whitened apart, each length by itself;
    empty ones give no rows. A repeated row gives its rows each time, a null vec_id stays.
    deviation is null if it doesn't fit a long. Other columns are ignored. The driver holds
    the square of the number of dimensions, and no more.
    """
    typed = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    units = stored(typed.mapInArrow(_whole_numbers, "vec_id long, dims int, packed binary"), "whole")
    distinct = stored(units.groupBy("dims", "packed").agg(F.count("*").alias("rows")).drop("rows"), "fit-list")
    lengths = distinct.where("dims > 0").groupBy("dims").agg(F.count("*").alias("n")).collect()
    parts = [vectors.sparkSession.createDataFrame([], _OUT)]
    for dims, n in sorted(map(tuple, lengths)):
        model = fit(distinct.where(F.col("dims") == dims).select("packed"), dims, n, components)
        if len(model.values):
            mine = units.where(F.col("dims") == dims).select("vec_id", "packed")
            parts.append(mine.mapInArrow(partial(_project, model=model), _OUT))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def fit(distinct: DataFrame, dims: int, n: int, components: int = COMPONENTS) -> Whitening:
    """Mean, leading components and how far the whitened covariance is from the identity."""
    high, low = F.col("high").cast("decimal(38,0)"), F.col("low").cast("decimal(38,0)")
    halves = distinct.mapInArrow(partial(_sums, dims=dims), "i int, high long, low long")
    sums = [0] * dims
    for row in halves.groupBy("i").agg(F.sum(high).alias("high"), F.sum(low).alias("low")).collect():
        sums[row["i"]] = (int(row["high"]) << 32) + int(row["low"])
    model = Whitening(n, sums, np.zeros(0), np.zeros((0, dims)), 0.0)
    covariance = _covariance(distinct, model.mean, np.eye(dims), n)
    model.trace = float(np.trace(covariance))
    model.values, model.components = leading(covariance, components)
    if len(model.values):
        turned = model.map
        # The whitened vectors' own mean is zero but for rounding; it is taken off all the same.
        sums = distinct.mapInArrow(partial(_whitened_sums, mean=model.mean, turn=turned), "i int, value double")
        centre = np.zeros(len(turned))
        for row in sums.groupBy("i").agg(F.sum("value").alias("value")).collect():
            centre[row["i"]] = row["value"] / n
        spread = _covariance(distinct, model.mean, turned, n, centre)
        model.identity_error = float(np.abs(spread - np.eye(len(turned))).max())
    return model


def _covariance(
    distinct: DataFrame, mean: np.ndarray, turn: np.ndarray, n: int, centre: np.ndarray | None = None
) -> np.ndarray:
    """Covariance of turn (x - mean) - centre over the fit list, from sums of each task."""
    products = distinct.mapInArrow(
        partial(_products, mean=mean, turn=turn, centre=centre), "i int, j int, value double"
    )
    out = np.zeros((len(turn), len(turn)))
    for row in products.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = row["value"] / n
    return out


def _whole_numbers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """floor(64 c) of each entry in the fewest bytes that hold the vector: equal vectors have equal bytes."""
    for batch in batches:
        ids, dims, packed = [], [], []
        for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
            if not vector.is_valid or vector.values.null_count:
                continue
            entries = vector.values.to_numpy(zero_copy_only=False)
            if not np.isfinite(entries).all():
                continue
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(SCALE * entries), -float(_EDGE), float(_EDGE)).astype(np.int64)
            top = int(np.abs(whole).max(initial=0))
            kind = np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64
            ids.append(vec_id)
            dims.append(len(whole))
            packed.append(whole.astype(kind).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(packed, pa.binary())],
            ["vec_id", "dims", "packed"],
        )


def _unpacked(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a batch, one row each."""
    kinds = {2: np.int16, 4: np.int32, 8: np.int64}
    out = np.empty((len(column), dims), np.int64)
    for at, packed in enumerate(column):
        raw = packed.as_buffer()
        out[at] = np.frombuffer(raw, kinds[raw.size // dims])
    return out


def _groups(batches: Iterable[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            part = batch.slice(begin, ROWS)
            yield part, _unpacked(part.column(part.schema.get_field_index("packed")), dims)


def _sums(batches: Iterable[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """Exact sums of a task, in two halves that don't overflow."""
    high, low = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
    for _, rows in _groups(batches, dims):
        high += (rows >> 32).sum(0)
        low += (rows & 0xFFFFFFFF).sum(0)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(dims, dtype=np.int32)), pa.array(high), pa.array(low)], ["i", "high", "low"]
    )


def _products(
    batches: Iterable[pa.RecordBatch], mean: np.ndarray, turn: np.ndarray, centre: np.ndarray | None
) -> Iterator[pa.RecordBatch]:
    """Sums of products of centred entries, for each pair of dimensions of a task."""
    total = np.zeros((len(turn), len(turn)))
    for _, rows in _groups(batches, len(mean)):
        centred = rows - mean
        if centre is not None:
            centred = centred @ turn.T - centre
        total += centred.T @ centred
    i, j = np.triu_indices(len(turn))
    columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])]
    yield pa.RecordBatch.from_arrays(columns, ["i", "j", "value"])


def _whitened_sums(
    batches: Iterable[pa.RecordBatch], mean: np.ndarray, turn: np.ndarray
) -> Iterator[pa.RecordBatch]:
    total = np.zeros(len(turn))
    for _, rows in _groups(batches, len(mean)):
        total += ((rows - mean) @ turn.T).sum(0)
    places = pa.array(np.arange(len(turn), dtype=np.int32))
    yield pa.RecordBatch.from_arrays([places, pa.array(total)], ["i", "value"])


def _project(batches: Iterable[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    k, dims = model.components.shape
    turn, mean = model.map, model.mean
    for part, rows in _groups(batches, dims):
        many = len(rows)
        columns = [
            part.column(0).take(pa.array(np.repeat(np.arange(many), k))),
            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
            pa.array(np.full(many * k, model.n)),
            deviations(rows, model).take(pa.array(np.repeat(np.arange(many), k))),
            pa.array(((rows - mean) @ turn.T).ravel()),
            pa.array(np.tile(model.values / model.trace, many)),
            pa.array(np.full(many * k, model.identity_error)),
        ]
        yield pa.RecordBatch.from_arrays(
            columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        )


def deviations(rows: np.ndarray, model: Whitening) -> pa.Array:
    """Sum over dimensions of (n x - S) ** 2, exact; null beyond a long.

    64-bit numbers wrap round, so a sum that fits comes out right whatever overflowed on the way.
    """
    wrapped = np.array([(s + (1 << 63)) % (1 << 64) - (1 << 63) for s in model.sums], np.int64)
    with np.errstate(over="ignore"):
        exact = ((rows * np.int64(model.n) - wrapped) ** 2).sum(1)
    about = ((rows - model.mean) ** 2).sum(1) * float(model.n) ** 2
    out: list[int | None] = exact.tolist()
    for at in np.flatnonzero(about > 0.9 * _LIMIT).tolist():
        true = sum((model.n * int(x) - s) ** 2 for x, s in zip(rows[at].tolist(), model.sums))
        out[at] = true if true <= _LIMIT else None
    return pa.array(out, pa.int64())


# Eigenvalues and eigenvectors of a symmetric matrix


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The `count` greatest positive eigenvalues, falling, and their unit vectors as rows."""
    size = len(matrix)
    scale = float(np.abs(matrix).max(initial=0.0))
    if not scale > 0 or not np.isfinite(scale):
        return np.zeros(0), np.zeros((0, size))
    diagonal, beside, reflectors = tridiagonal(matrix / scale)
    values = bisect(diagonal, beside, min(count, size))
    values = values[values > LEAST * values[0]]
    vectors = inverse_iteration(diagonal, beside, values)
    for at, mirror in reversed(reflectors):
        part = vectors[:, at:]
        part -= 2 * np.outer(part @ mirror, mirror)
    most = np.abs(vectors).argmax(1)
    vectors *= np.sign(vectors[np.arange(len(vectors)), most])[:, None]
    return values * scale, vectors


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal and its neighbour after Householder reflections, and the reflections, in order."""
    a = np.array(matrix, float)
    reflectors = []
    for j in range(len(a) - 2):
        column = a[j + 1 :, j]
        if not np.abs(column[1:]).max() > 0:
            continue
        mirror = column.copy()
        mirror[0] += np.copysign(np.linalg.norm(column), column[0])
        mirror /= np.linalg.norm(mirror)
        below = a[j + 1 :, j + 1 :]
        push = 2 * (below @ mirror)
        push -= (push @ mirror) * mirror
        below -= np.outer(mirror, push) + np.outer(push, mirror)
        column -= 2 * (mirror @ column) * mirror
        reflectors.append((j + 1, mirror))
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), reflectors


def smaller(diagonal: np.ndarray, beside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues are smaller than each of `at`: the negative terms of a Sturm sequence."""
    tiny = np.finfo(float).tiny ** 0.5
    squares = beside**2
    term, found = np.ones(len(at)), np.zeros(len(at), int)
    for i, entry in enumerate(diagonal):
        term = entry - at - (squares[i - 1] / term if i else 0)
        term = np.where(np.abs(term) < tiny, -tiny, term)
        found += term < 0
    return found


def bisect(diagonal: np.ndarray, beside: np.ndarray, count: int) -> np.ndarray:
    """The `count` greatest eigenvalues, falling, as near as doubles can tell."""
    around = np.append(np.abs(beside), 0) + np.append(0, np.abs(beside))
    low = np.full(count, (diagonal - around).min() - 1e-300)
    high = np.full(count, (diagonal + around).max())
    high = np.nextafter(high, np.inf)
    rank = len(diagonal) - 1 - np.arange(count)  # so many are smaller than the wanted one
    for _ in range(2_000):
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        above = smaller(diagonal, beside, middle) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2


def _solver(diagonal: np.ndarray, beside: np.ndarray, value: float, least: float):
    """A function that solves (T - value) x = b, by elimination with row exchanges."""
    n = len(diagonal)
    d, right, far = diagonal - value, np.append(beside, 0.0), np.zeros(n)
    steps = []
    for i in range(n - 1):
        under = beside[i]
        swap = abs(under) > abs(d[i])
        if swap:
            d[i], right[i], far[i], d[i + 1], right[i + 1], under = (
                under, d[i + 1], right[i + 1], right[i], 0.0, d[i],
            )
        if abs(d[i]) < least:
            d[i] = np.copysign(least, d[i])
        factor = under / d[i]
        d[i + 1] -= factor * right[i]
        if swap:
            right[i + 1] = -factor * far[i]
        steps.append((swap, factor))
    if abs(d[-1]) < least:
        d[-1] = np.copysign(least, d[-1])

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.copy()
        for i, (swap, factor) in enumerate(steps):
            if swap:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= factor * x[i]
        x[-1] /= d[-1]
        if n > 1:
            x[-2] = (x[-2] - right[-2] * x[-1]) / d[-2]
        for i in range(n - 3, -1, -1):
            x[i] = (x[i] - right[i] * x[i + 1] - far[i] * x[i + 2]) / d[i]
        return x

    return solve


def inverse_iteration(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors as rows; those of a cluster are kept orthogonal while they are found."""
    n = len(diagonal)
    norm = float((np.abs(diagonal) + np.append(np.abs(beside), 0) + np.append(0, np.abs(beside))).max())
    least = np.finfo(float).eps * norm
    random = np.random.default_rng(13)
    vectors = np.zeros((len(values), n))
    first, shift = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        # Equal eigenvalues are told apart by a few roundings.
        shift = min(value, shift - 10 * least) if k > first else value
        solve = _solver(diagonal, beside, shift, least)
        x = random.normal(size=n)
        for _ in range(5):
            x = solve(x / np.linalg.norm(x))
            x /= np.abs(x).max()
            for _ in range(2):
                x -= vectors[first:k].T @ (vectors[first:k] @ x)
        vectors[k] = x / np.linalg.norm(x)
    return vectors
