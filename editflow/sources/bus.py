"""The message bus: frames of a key and a value, both binary.

The Avro codec needs the spark-avro package, a Kafka bus the Kafka connector;
Spark says so when they are missing.
"""

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.functions.generate import once
from editflow.functions.text import flags_to_text, iso_millis
from editflow.operators.parse import normalize_edits
from editflow.schema import FRAMES, WIRE, WIRE_FIELDS

AVRO_SCHEMA = json.dumps(
    {
        "type": "record",
        "name": "Edit",
        "fields": [{"name": key, "type": kind} for key, _, kind in WIRE_FIELDS],
    }
)


def _wire_record():
    columns = []
    for key, column, _ in WIRE_FIELDS:
        value = F.col(column)
        if column == "ts":
            value = iso_millis(value)
        elif column == "flags":
            value = flags_to_text(value)
        columns.append(value.alias(key))
    return F.struct(*columns)


def encode_bus(df: DataFrame, codec: str = "json", keep: Sequence[str] = ()) -> DataFrame:
    """Typed edits to frames, beside the columns to keep. The key is the channel in UTF-8."""
    if codec == "avro":
        from pyspark.sql.avro.functions import to_avro

        value = to_avro(_wire_record(), AVRO_SCHEMA)
    else:
        value = F.encode(F.to_json(_wire_record()), "UTF-8")
    return df.select(*keep, F.encode("channel", "UTF-8").alias("key"), value.alias("value"))


def decode_bus(df: DataFrame, codec: str = "json") -> DataFrame:
    """Frames to typed edits with `_ok`; a value that cannot be decoded is not ok."""
    if codec == "avro":
        from pyspark.sql.avro.functions import from_avro

        record = from_avro("value", AVRO_SCHEMA, {"mode": "PERMISSIVE"})
    else:
        record = F.from_json(F.decode("value", "UTF-8"), WIRE)
    kept = [c for c in df.columns if c not in ("key", "value")]
    return normalize_edits(once(df, {"_record": record}).select(*kept, "_record.*"))


def read_bus(spark: SparkSession, options: dict[str, str], start: str = "committed") -> DataFrame:
    """Stream of frames with their partition and offset. A restarted query goes on from its checkpoint.

    start='committed' begins a new query with all that the topic holds,
    start='latest' with what comes next. `format` in the options names another
    source of (key, value), such as a folder of Parquet files; partition and offset are null
    where it has none.
    """
    options = dict(options)
    source = options.pop("format", "kafka")
    if source == "kafka":
        first = "latest" if start == "latest" else "earliest"
        reader = spark.readStream.format("kafka").option("startingOffsets", first)
        frames = reader.options(**options).load()
    else:
        frames = spark.readStream.format(source).schema(FRAMES).options(**options).load()
    return frames.select("key", "value", "partition", "offset")


def write_bus(df: DataFrame, options: dict[str, str]):
    """Publish frames; a stream gives its writer's query, a batch nothing."""
    options = dict(options)
    sink = options.pop("format", "kafka")
    if df.isStreaming:
        return df.writeStream.format(sink).options(**options).start()
    return df.write.format(sink).mode("append").options(**options).save()
