"""Channels to follow."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.functions.text import channel_name

# Wiki codes that are followed by default. Fixed values.
WIKI_CODES = (
    "en sv de nl fr war ru ceb it es vi pl ja pt zh uk ca fa sh no ar fi id ro hu cs ko sr ms "
    "tr min eo kk eu da bg sk hy he lt hr sl et uz gl nn la vo simple el ce hi be"
).split()


def channel_catalog(
    spark: SparkSession, codes: DataFrame | list[str] | None = None, with_all: bool = False
) -> DataFrame:
    """Channels of wiki codes (a list or a frame with column `code`), `all` as an option."""
    if not isinstance(codes, DataFrame):
        listed = WIKI_CODES if codes is None else codes
        codes = spark.createDataFrame([(code,) for code in listed], "code string")
    if with_all:
        codes = codes.select("code").union(spark.createDataFrame([("all",)], "code string"))
    trimmed = F.trim("code").alias("code")
    return codes.select(trimmed, channel_name(F.col("code")).alias("channel"))
