"""The model table, and the metric table."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.schema import MODEL


def save_models(df: DataFrame, path: str) -> None:
    """Store models by ISO year, week and channel; a model that is saved again replaces the old one."""
    writer = df.select(*MODEL.fieldNames()).repartition("year", "week", "channel").write
    writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("year", "week", "channel").parquet(path)


def load_models(spark: SparkSession, path: str) -> DataFrame:
    """All models under path; none if the path is missing."""
    try:
        return spark.read.schema(MODEL).parquet(path).select(*MODEL.fieldNames())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MODEL)


def metric_rows(df: DataFrame) -> DataFrame:
    """Counter results (bucket, name, n) with their counter line."""
    line = F.concat("name", F.lit(":"), F.col("n").cast("string"), F.lit("|c"))
    return df.select("bucket", "name", F.col("n").alias("value"), line.alias("line"))


def write_metrics(df: DataFrame, path: str) -> None:
    metric_rows(df).write.mode("append").parquet(path)
