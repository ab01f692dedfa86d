"""Text lines and JSON lines."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.functions.text import flags_to_text, iso_millis
from editflow.schema import WIRE_FIELDS


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the files under path, in column `raw`."""
    return spark.read.text(path).withColumnRenamed("value", "raw")


def stream_lines(spark: SparkSession, directory: str, max_files: int = 1000) -> DataFrame:
    """An endless line source: files that land in a directory."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    return reader.text(directory).withColumnRenamed("value", "raw")


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan of a few files that cannot be split over all cores, before it is parsed."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def json_lines(df: DataFrame, view: str = "source", keep: Sequence[str] = ()) -> DataFrame:
    """One JSON object per edit, in column `line`, beside the columns to keep.

    The source view has 15 keys. The live view has the id as well, flags as a list
    and the timestamp in milliseconds.
    """
    live = view == "live"
    columns = []
    for key, column, _ in WIRE_FIELDS:
        value = F.col(column)
        if column == "id" and not live:
            continue
        if column == "ts":
            value = F.unix_millis(value) if live else iso_millis(value)
        elif column == "flags" and not live:
            value = flags_to_text(value)
        columns.append(value.alias(key))
    return df.select(*keep, F.to_json(F.struct(*columns)).alias("line"))


def write_json_lines(df: DataFrame, path: str, view: str = "source") -> None:
    json_lines(df, view).write.mode("append").text(path)
