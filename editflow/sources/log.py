"""A table of Parquet files under a log of versions.

A version names the segments of the manifest that make it up. A segment is a Parquet table
of files that were added or removed, one row each: its day, number of rows, bytes, the least
and greatest second of the day, and a Bloom filter of its ids. Data files are never changed,
so a reader keeps the files of the version that it began with.

A writer prepares its files, then creates the next version's file, which only one writer
can. The other one has lost nothing: it looks at the new version and does its work again.
"""

import functools
import json
import math
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.functions.skew import lookup_join
from editflow.operators.series import clustering_order
from editflow.schema import STORED, STORED_KEY, STORED_PARTITIONS
from editflow.session import create_once, list_paths, materialize, read_text, remove_path

# Readers of a folder pass over names that begin with an underscore.
LOG = "_log"
# A version that names more segments than this has its manifest written anew, as one segment.
SEGMENTS = 20
# A writer whose version was taken by others tries again so often.
TRIES = 20
# Files of so many bytes are not merged any more.
WHOLE = 256 << 20
# Bits per id and probes per id: about one id in 80 is taken for a member of a file wrongly.
BITS_PER_ID, PROBES = 10, 4

FILE = (
    "file string, year int, month int, day int, rows long, bytes long, least int, greatest int, "
    "bloom array<long>, removed boolean"
)
_RANGES = ["file", *STORED_PARTITIONS, "rows", "bytes", "least", "greatest"]


class Conflict(RuntimeError):
    """Other writers took every version that this one tried."""


@dataclass
class Version:
    number: int = -1
    segments: list[str] = field(default_factory=list)
    # The last batch of each named stream, and the folder of the files that it added.
    applied: dict[str, tuple[int, str]] = field(default_factory=dict)


def latest(spark: SparkSession, path: str) -> Version:
    """The newest version; number -1 if there is none."""
    found = list_paths(spark, f"{path}/{LOG}/*.json")
    return at_version(spark, path, int(found[-1].rpartition("/")[2][:-5])) if found else Version()


def at_version(spark: SparkSession, path: str, number: int) -> Version:
    read = json.loads(read_text(spark, f"{path}/{LOG}/{number:020d}.json"))
    return Version(number, read["segments"], read["applied"])


def files(spark: SparkSession, path: str, version: Version) -> DataFrame:
    """The live files of a version (see FILE)."""
    if not version.segments:
        return spark.createDataFrame([], FILE).drop("removed")
    rows = spark.read.schema(FILE).parquet(*[f"{path}/{LOG}/{s}" for s in version.segments])
    gone = rows.where("removed").select("file")
    return rows.where("not removed").drop("removed").join(gone, "file", "left_anti")


def read_files(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Rows of some files of the table, with the column _file."""
    if not names:
        return spark.createDataFrame([], STORED).withColumn("_file", F.lit(None).cast("string"))
    # Files of a folder that was taken over lie beside the commits, one level higher.
    taken = [n for n in names if not n.startswith("commit=")]
    made = [n for n in names if n.startswith("commit=")]
    parts = [_read(spark, path, some) for some in (made, taken) if some]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _read(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    reader = spark.read.schema(STORED).option("basePath", path)
    # All of these names have as many parts.
    name = F.substring_index("_metadata.file_path", "/", -1 - names[0].count("/"))
    return reader.parquet(*[f"{path}/{n}" for n in names]).select(*STORED.fieldNames(), name.alias("_file"))


def _name(column: str) -> Column:
    """A file's path below the table."""
    return F.regexp_extract(column, r"((commit=[^/]+/)?year=[^/]+/month=.*)\z", 1)


def adopt(spark: SparkSession, path: str) -> Version:
    """The newest version; files of a folder that has no log yet become its first one."""
    while True:
        base = latest(spark, path)
        old = f"{path}/year=*/month=*/day=*/*.parquet"
        if base.number >= 0 or not list_paths(spark, old):
            return base
        commit(spark, path, base, "year=*/month=*/day=*/*.parquet")


def names_of(found: DataFrame) -> list[str]:
    """Paths of files, as Spark's own file index holds them too."""
    return sorted(r["file"] for r in found.select("file").collect())


def add_files(rows: DataFrame, path: str) -> str:
    """Write rows, in order, as files of a new folder; its name. No version has them yet."""
    folder = f"commit={uuid.uuid4().hex}"
    rows.write.partitionBy(*STORED_PARTITIONS).parquet(f"{path}/{folder}")
    return folder


def read_folder(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """Rows of the files that one commit added."""
    found = list_paths(spark, f"{path}/{folder}/*/*/*/*.parquet")
    return read_files(spark, path, [f[f.rindex("commit=") :] for f in found]).drop("_file")


def describe(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """The manifest's rows of written files, from their ids and times alone."""
    if not list_paths(spark, pattern):
        return spark.createDataFrame([], FILE)
    rows = spark.read.schema(STORED).option("basePath", path).parquet(pattern)
    whole, size = F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("bytes")
    rows = rows.select(whole, size, *STORED_PARTITIONS, "time", "id")
    ranges = rows.groupBy("_path", "bytes", *STORED_PARTITIONS).agg(
        F.count("*").alias("rows"), F.min("time").alias("least"), F.max("time").alias("greatest")
    )
    # Files go by a number: their paths would be longer than all else in the rows of the bits.
    ranges = ranges.withColumns(
        {"file": _name("_path"), "_words": _words(F.col("rows")), "_no": F.monotonically_increasing_id()}
    )
    ranges = materialize(ranges, "ranges")
    sized = lookup_join(rows.select("_path", "id"), ranges.select("_path", "_no", "_words"), ["_path"], spread=["id"])
    bits = sized.select("_no", F.explode(_probes(F.col("id"), F.col("_words"))).alias("bit"))
    one = F.expr("shiftleft(1L, cast(bit % 64 as int))")
    marks = bits.select("_no", F.shiftright("bit", 6).alias("word"), one.alias("mark"))
    # A word without marks is there, too, so that a word's place is its number.
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_words") - 1))
    none = ranges.select("_no", every.alias("word"), F.lit(0).cast("long").alias("mark"))
    words = marks.unionByName(none).groupBy("_no", "word").agg(F.bit_or("mark").alias("set"))
    held = words.groupBy("_no").agg(F.sort_array(F.collect_list(F.struct("word", "set")))["set"].alias("bloom"))
    return ranges.join(held, "_no").select(*_RANGES, "bloom", F.lit(False).alias("removed"))


def _words(rows: Column) -> Column:
    return F.ceil(rows * BITS_PER_ID / F.lit(64.0)).cast("long")


def _probes(edit_id: Column, words: Column) -> Column:
    """The bits of an id in a filter of so many words, by two hashes."""
    first = F.shiftrightunsigned(F.xxhash64(edit_id), 2)
    second = F.shiftrightunsigned(F.xxhash64(edit_id, F.lit(1)), 5)
    return F.array(*[F.pmod(first + second * i, words * 64) for i in range(PROBES)])


def may_hold(edit_id: Column, bloom: Column) -> Column:
    """False only if no row of the filter's file has the id."""
    bits = [F.get(_probes(edit_id, F.size(bloom).cast("long")), F.lit(i)) for i in range(PROBES)]
    # One condition for each probe: Spark compiles these, but not a function over a list.
    found = [F.getbit(F.get(bloom, F.shiftright(b, 6).cast("int")), (b % 64).cast("int")) == 1 for b in bits]
    return functools.reduce(lambda a, b: a & b, found)


def digest() -> Column:
    """A number for a row's key. Equal keys have equal ones; others hardly ever."""
    return F.xxhash64(*STORED_KEY)


def holding(keys: DataFrame, live: DataFrame) -> DataFrame:
    """Live files, each with the digests of the keys (STORED_KEY) that it may hold, by day, time and id.

    Days with their least and greatest time choose files first; then each key meets the
    files of its day and slot of the day, and its id their filters.
    """
    spans = keys.groupBy(*STORED_PARTITIONS).agg(F.min("time").alias("_from"), F.max("time").alias("_upto"))
    near = live.join(spans, STORED_PARTITIONS).where("least <= _upto and greatest >= _from")
    near = materialize(near.drop("_from", "_upto"), "near")
    slots = F.sequence(_slot(F.col("least")), _slot(F.col("greatest")))
    ranges = near.select(*STORED_PARTITIONS, "file", "least", "greatest", F.explode(slots).alias("slot"))
    asked = keys.select(*STORED_PARTITIONS, "time", "id", _slot(F.col("time")).alias("slot"), digest().alias("digest"))
    pairs = lookup_join(asked, ranges, [*STORED_PARTITIONS, "slot"], spread=["id"])
    pairs = pairs.where(F.col("time").between(F.col("least"), F.col("greatest"))).select("file", "id", "digest")
    found = lookup_join(pairs, near.select("file", "bloom"), ["file"], spread=["id"])
    return materialize(found.where(may_hold(F.col("id"), F.col("bloom"))).select("file", "digest"), "asked")


def _slot(second: Column) -> Column:
    """One of 288 parts of a day."""
    return F.floor(second / 300).cast("int")


def commit(
    spark: SparkSession,
    path: str,
    base: Version,
    pattern: str,
    removed: list[str] = (),
    applied: dict[str, tuple[int, str]] | None = None,
) -> Version | None:
    """The version after `base`, with the files that a pattern names below the table.

    None if another writer made one meanwhile.
    """
    name = f"segment-{uuid.uuid4().hex}"
    rows = describe(spark, path, f"{path}/{pattern}")
    if len(base.segments) >= SEGMENTS:
        rest = files(spark, path, base).where(~F.col("file").isin(list(removed)))
        rows = rest.withColumn("removed", F.lit(False)).unionByName(rows)
        segments = [name]
    else:
        gone = spark.createDataFrame([(f,) for f in removed], "file string").withColumn("removed", F.lit(True))
        rows = rows.unionByName(gone, allowMissingColumns=True) if removed else rows
        segments = [*base.segments, name]
    rows.write.parquet(f"{path}/{LOG}/{name}")
    new = Version(base.number + 1, segments, base.applied | (applied or {}))
    text = json.dumps({"segments": new.segments, "applied": new.applied})
    if create_once(spark, f"{path}/{LOG}/{new.number:020d}.json", text):
        return new
    remove_path(spark, f"{path}/{LOG}/{name}")
    return None


def compact(spark: SparkSession, path: str, fan_in: int = 8, before: str | None = None) -> int:
    """Merge a day's files of one size class into larger ones, wherever there are `fan_in` of them.

    Classes are powers of fan_in, so a row is rewritten once per class, and a day keeps fewer
    than fan_in files in each, but for those that are written meanwhile. `before` leaves days
    alone that have not begun by then (ISO date). Rows don't change. The number of files merged;
    none if another writer made a version meanwhile.
    """
    base = latest(spark, path)
    live = files(spark, path, base).drop("bloom")
    if before is not None:
        live = live.where(F.make_date("year", "month", "day") < F.lit(before).cast("date"))
    size = F.floor(F.log(F.col("bytes").cast("double")) / math.log(fan_in))
    live = live.where(F.col("bytes") < WHOLE).withColumn("_class", size)
    many = live.groupBy(*STORED_PARTITIONS, "_class").agg(F.count("*").alias("_n")).where(F.col("_n") >= fan_in)
    names = names_of(live.join(many, [*STORED_PARTITIONS, "_class"]))
    if not names:
        return 0
    merged = clustering_order(read_files(spark, path, names).drop("_file"))
    done = commit(spark, path, base, f"{add_files(merged, path)}/*/*/*/*.parquet", names)
    return 0 if done is None else len(names)


def vacuum(spark: SparkSession, path: str, keep: int = 10) -> int:
    """Remove versions but the newest `keep`, and segments and files that no kept version names.

    No writer may be at work, and no reader on an older version. The number of files removed.
    """
    numbers = [int(p.rpartition("/")[2][:-5]) for p in list_paths(spark, f"{path}/{LOG}/*.json")]
    kept = [at_version(spark, path, n) for n in numbers[-keep:]]
    segments = {s for v in kept for s in v.segments}
    named = {f for v in kept for f in names_of(files(spark, path, v))}
    for number in numbers[:-keep]:
        remove_path(spark, f"{path}/{LOG}/{number:020d}.json")
    for segment in list_paths(spark, f"{path}/{LOG}/segment-*"):
        if segment.rpartition("/")[2] not in segments:
            remove_path(spark, segment)
    gone = [f for f in list_paths(spark, f"{path}/commit=*/*/*/*/*.parquet") if f[f.rindex("commit=") :] not in named]
    for file in gone:
        remove_path(spark, file)
    return len(gone)
