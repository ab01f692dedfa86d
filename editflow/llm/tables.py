"""Reading the given tables, cutting lineage, and Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from editflow.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder of spark.checkpoint.dir and read it back.

    A lost executor then costs a read, not the work before it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BUCKETS = 50_000


def bucketed(rows: DataFrame, buckets: int, key: str) -> DataFrame:
    """Write rows to the shared folder in buckets of a key and read them back.

    A join or group by the key then moves the other side only.
    """
    spark, name = rows.sparkSession, f"editflow_{uuid.uuid4().hex}"
    writer = rows.write.bucketBy(min(BUCKETS, max(1, buckets)), key).option("compression", "zstd")
    writer.option("path", scratch_path(spark, "buckets")).saveAsTable(name)
    found = spark.table(name)
    # The frame knows its files; only the catalogue's entry goes.
    spark.sql(f"drop table {name}")
    return found


# A table of keys with no more rows than this (16 bytes each) may be sent to all executors.
BROADCAST_KEYS = 2_000_000


def having(rows: DataFrame, wanted: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """The rows whose key is in `wanted`, a stored table of one key column; with left_anti, is not.

    The keys are counted: up to BROADCAST_KEYS they go to the rows, beyond that both
    sides are shuffled.
    """
    small = wanted.count() <= BROADCAST_KEYS
    return rows.join(wanted.hint("broadcast") if small else wanted, key, how)


_DRAWS = 1 << 40


def sampled(rows: DataFrame, key: Sequence[str], count: int, label: str) -> list[Row]:
    """`count` rows, the same ones in every run: those with the least hashes of their key.

    Only rows below a cutoff that leaves about twice as many are stored, and those are
    sorted. So what reaches the driver is bounded by `count`, however many tasks there are.
    Rows with equal keys count once.
    """
    drawn = F.pmod(F.xxhash64(*key), F.lit(_DRAWS))
    total = rows.agg(F.approx_count_distinct(drawn)).first()[0]
    cutoff = _DRAWS if total <= 2 * count else _DRAWS * 2 * count // total
    chosen = rows.withColumn("_drawn", drawn).where(F.col("_drawn") < cutoff).dropDuplicates(["_drawn"])
    return stored(chosen, label).orderBy("_drawn").limit(count).collect()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column end to end, and where each row starts (one more than rows).

    Nulls are empty.
    """
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)
    starts = starts[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def spans(starts: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows with at most `limit` bytes together; a larger row comes alone."""
    row, rows = 0, len(starts) - 1
    while row < rows:
        upto = int(np.searchsorted(starts, starts[row] + limit, "right")) - 1
        upto = max(upto, row + 1)
        yield row, upto
        row = upto


def runs(
    batches: Iterable[pa.RecordBatch], keys: Sequence[str]
) -> Iterator[tuple[tuple, pa.RecordBatch, bool]]:
    """Pieces of rows with equal keys from sorted batches: key, piece, whether it starts a new key.

    A key's rows come in several pieces if they span batches, so memory is bounded by a batch.
    """
    last: tuple | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for column in columns:
            same = pc.equal(column[1:], column[:-1])
            change[1:] |= ~np.asarray(pc.fill_null(same, False).to_numpy(zero_copy_only=False), bool)
        edges = np.append(np.flatnonzero(change), batch.num_rows)
        for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            key = tuple(c[begin].as_py() for c in columns)
            yield key, batch.slice(begin, end - begin), key != last
            last = key
