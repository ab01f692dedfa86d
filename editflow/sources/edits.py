"""The stored edit table: Parquet, partitioned by calendar, one row per key, under a log of versions."""

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editflow.functions.calendar import iso_year, months_of_week
from editflow.operators.filters import filter_channel, filter_week
from editflow.operators.parse import calendar_fields
from editflow.operators.series import clustering_order
from editflow.schema import STORED, STORED_KEY, STORED_PARTITIONS
from editflow.session import materialize, scratch_scope
from editflow.sources import log

# As many keys as are sent to all tasks, 8 bytes each.
FEW_KEYS = 1_000_000


def read_edits(
    spark: SparkSession,
    path: str,
    channel: str | None = None,
    week: int | None = None,
    columns: list[str] | None = None,
    year: int | None = None,
    version: int | None = None,
) -> DataFrame:
    """Scan of the stored table, as of its newest version or an older one that is kept.

    The files are chosen here, so later writes don't change what is read. `year` is an ISO
    year. The channel and week filters reach the Parquet reader; week and
    year also limit the folders that are read.
    """
    folders = F.lit(True)
    if year is not None:
        folders = _folders(year, week)
    elif week is not None:
        folders = F.col("month").isin(_months(week))
    found = log.latest(spark, path) if version is None else log.at_version(spark, path, version)
    if found.number < 0:
        edits = spark.read.schema(STORED).parquet(path)
    else:
        names = log.names_of(log.files(spark, path, found).where(folders))
        edits = log.read_files(spark, path, names).drop("_file")
    edits = edits.where(folders)
    if year is not None:
        edits = edits.where(iso_year() == year)
    if week is not None:
        edits = filter_week(edits, week)
    if channel is not None:
        edits = filter_channel(edits, channel)
    return edits if columns is None else edits.select(*columns)


def _folders(year: int, week: int | None) -> Column:
    """Filter on the years and months that hold days of an ISO year, or of a week of it."""
    if week is None:
        return F.col("year").between(year - 1, year + 1)
    return functools.reduce(
        lambda a, b: a | b,
        [(F.col("year") == y) & (F.col("month") == m) for y, m in months_of_week(year, week)],
        F.lit(False),
    )


@functools.cache
def _months(week: int) -> list[int]:
    """Calendar months in which days of an ISO week number can lie, in any year."""
    # The calendar repeats after 400 years, so these years hold every case.
    return sorted({month for year in range(2000, 2400) for _, month in months_of_week(year, week)})


def get_by_id(df: DataFrame, edit_id: str) -> DataFrame:
    return df.where(F.col("id") == edit_id).limit(1)


def find_edit(spark: SparkSession, path: str, edit_id: str) -> DataFrame:
    """The stored rows with an id. Only files are opened whose filter says that they may hold it."""
    live = log.files(spark, path, log.latest(spark, path))
    names = log.names_of(live.where(log.may_hold(F.lit(edit_id), F.col("bloom"))))
    return log.read_files(spark, path, names).drop("_file").where(F.col("id") == edit_id)


def stored_total(spark: SparkSession, path: str) -> DataFrame:
    """Number of stored edits, from the manifest alone."""
    live = log.files(spark, path, log.latest(spark, path))
    return live.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))


def latest_per_key(df: DataFrame) -> DataFrame:
    """The last row of each key. Spark drops earlier copies in each task before the shuffle.

    Frames of a bus have an `offset`: rows of one key come from one partition of the bus, so
    the greatest offset came last. Rows without one go by their timestamp.
    """
    arrival = [F.desc_nulls_last("offset")] if "offset" in df.columns else []
    rest = [c for c in STORED.fieldNames() if c not in STORED_KEY and c != "ts"]
    # By id first: rows are sorted by the first bytes of it, the other columns hardly ever decide.
    newest = Window.partitionBy(*reversed(STORED_KEY)).orderBy(*arrival, F.desc("ts"), *[F.desc(c) for c in rest])
    last = df.withColumn("_copy", F.row_number().over(newest)).where("_copy = 1")
    return last.select(*STORED.fieldNames())


def _one_per_key(rows: DataFrame) -> DataFrame:
    """`latest_per_key` of a stored frame. Only rows whose key comes again are moved and sorted."""
    same = rows.groupBy(log.digest().alias("_digest")).agg(F.count("*").alias("_n"))
    again = materialize(same.where("_n > 1").select("_digest"), "again")
    copies = again.count()
    if not copies:
        return rows.select(*STORED.fieldNames())
    if copies > FEW_KEYS:
        return materialize(latest_per_key(rows), "latest")
    marked, listed = rows.withColumn("_digest", log.digest()), F.broadcast(again)
    latest = materialize(latest_per_key(marked.join(listed, "_digest", "left_semi").drop("_digest")), "latest")
    return marked.join(listed, "_digest", "left_anti").select(*STORED.fieldNames()).unionByName(latest)


def write_edits(
    df: DataFrame,
    path: str,
    wall: str = "utc",
    on_conflict: str = "replace",
    batch: tuple[str, int] | None = None,
    frozen: bool = False,
) -> None:
    """Store typed edits; an equal key overwrites, see `latest_per_key` for keys that repeat in df.

    New rows go to new files. With on_conflict='replace', files that hold one of the keys are
    written anew without it; with 'keep' the stored row stays and nothing is rewritten. `keep`
    is the same as `replace` for redelivered edits, which do not differ. Files that can't hold
    a key are not opened.

    All of it becomes visible at once, as the table's next version. If another writer made
    one meanwhile, the work is done again on top of it. `batch` names a stream and numbers its
    batch: one that the table has already is passed over.

    df is looked at several times, so it is written out first. `frozen` says that it reads files
    that stay as they are, with nothing dear or random on top: then it is read as it is.
    """
    spark = df.sparkSession
    with scratch_scope(spark):
        offset = [c for c in df.columns if c == "offset"]
        rows = calendar_fields(df, wall).select(*STORED.fieldNames(), *offset)
        rows = rows if frozen else materialize(rows, "batch")
        if rows.isEmpty():
            return
        rows = _one_per_key(rows)
        for _ in range(log.TRIES):
            base = log.adopt(spark, path)
            if batch is not None and _applied(base, batch):
                return
            if _upsert(rows, path, base, on_conflict, batch):
                return
    raise log.Conflict(f"{path}: {log.TRIES} versions were made by others meanwhile")


def _applied(base: log.Version, batch: tuple[str, int]) -> bool:
    return batch[0] in base.applied and base.applied[batch[0]][0] >= batch[1]


def first_deliveries(
    df: DataFrame, path: str, batch: tuple[str, int], wall: str = "utc"
) -> tuple[DataFrame, bool]:
    """Store edits; those that the table did not have before, and whether the batch is run again.

    A batch that is run again gives the same rows as before. So whatever is fed with these
    rows gets each edit once, however long ago its first delivery was.
    """
    spark = df.sparkSession
    again = _applied(log.latest(spark, path), batch)
    if not again:
        write_edits(df, path, wall, "keep", batch)
    done = log.latest(spark, path).applied.get(batch[0])
    if done is None or done[0] != batch[1]:  # a batch without edits makes no version
        return spark.createDataFrame([], STORED), again
    return log.read_folder(spark, path, done[1]), again


def _upsert(
    rows: DataFrame, path: str, base: log.Version, on_conflict: str, batch: tuple[str, int] | None
) -> bool:
    """Whether the rows became the table's next version."""
    spark, keep = rows.sparkSession, on_conflict == "keep"
    removed: list[str] = []
    ordered = None
    if base.segments:
        asked = log.holding(rows.select(*STORED_KEY), log.files(spark, path, base))
        names = log.names_of(asked.select("file").distinct())
        held = log.read_files(spark, path, names).select(*STORED_KEY, "_file")
        if names and keep:
            ordered = _merged(rows, _asked_few(held, asked), keep)
        elif names:
            removed = _files_of(held, asked)
        if removed:
            ordered = _merged(rows, log.read_files(spark, path, removed).drop("_file"), keep)
    folder = log.add_files(clustering_order(rows) if ordered is None else ordered, path)
    applied = {batch[0]: (batch[1], folder)} if batch else None
    return log.commit(spark, path, base, f"{folder}/*/*/*/*.parquet", removed, applied) is not None


def _asked_few(held: DataFrame, asked: DataFrame) -> DataFrame:
    """Stored keys that may be asked for; all of them if more are asked for than are sent to each task."""
    if asked.count() > FEW_KEYS:
        return held.select(*STORED_KEY)
    few = F.broadcast(asked.select("digest"))
    held = held.withColumn("digest", log.digest()).join(few, "digest", "left_semi")
    return materialize(held.select(*STORED_KEY), "held")


def _files_of(held: DataFrame, asked: DataFrame) -> list[str]:
    """The files that hold a key whose digest is asked for."""
    # Files go by a number: their paths would be longer than all else that is moved.
    numbers = held.select(log.digest().alias("digest"), F.xxhash64("_file").alias("_no"))
    wanted = asked.select("digest")
    wanted = F.broadcast(wanted) if asked.count() <= FEW_KEYS else wanted
    found = numbers.join(wanted, "digest", "left_semi").select("_no").distinct()
    listed = asked.select("file").distinct().withColumn("_no", F.xxhash64("file"))
    return log.names_of(listed.join(found, "_no", "left_semi"))


def _merged(rows: DataFrame, old: DataFrame, keep: bool) -> DataFrame:
    """Rows of a batch (one per key) and stored ones in the table's order; of a key, only those that stay.

    With `keep`, `old` are keys: what is stored under them stays where it is. Rows are moved and
    sorted once, for this and for the files alike. A key with a null is equal to none.
    """
    both = old.withColumn("_old", F.lit(True)).unionByName(rows.withColumn("_old", F.lit(False)), allowMissingColumns=True)
    first = F.desc("_old") if keep else F.asc("_old")
    # Equal keys lie in one range, so the window moves nothing.
    window = Window.partitionBy(*STORED_KEY).orderBy(first).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    unlike = functools.reduce(lambda a, b: a | b, [F.col(c).isNull() for c in STORED_KEY])
    stays = unlike | (F.first("_old").over(window) == F.col("_old"))
    both = both.repartitionByRange(*STORED_KEY).withColumn("_stays", stays).where("_stays")
    both = both.where(~F.col("_old")) if keep else both
    return both.select(*STORED.fieldNames()).sortWithinPartitions(*STORED_KEY)
