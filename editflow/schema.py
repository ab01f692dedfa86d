"""Schemas of the frames that move between operators.

Frames inside the package use snake_case columns, as in the stored table. JSON
lines and bus records use camelCase keys; WIRE_FIELDS maps one to the other.
"""

from pyspark.sql import types as T

# (wire key, column, wire type). Names, types and order of the wire record.
WIRE_FIELDS = [
    ("id", "id", "string"),
    ("isRobot", "is_robot", "boolean"),
    ("channel", "channel", "string"),
    ("timestamp", "ts", "string"),
    ("flags", "flags", "string"),
    ("isUnpatrolled", "is_unpatrolled", "boolean"),
    ("page", "page", "string"),
    ("diffUrl", "diff_url", "string"),
    ("added", "added", "int"),
    ("deleted", "deleted", "int"),
    ("comment", "comment", "string"),
    ("isNew", "is_new", "boolean"),
    ("isMinor", "is_minor", "boolean"),
    ("delta", "delta", "int"),
    ("user", "user", "string"),
    ("namespace", "namespace", "string"),
]

_SPARK_TYPES = {"string": T.StringType(), "boolean": T.BooleanType(), "int": T.IntegerType()}

WIRE = T.StructType([T.StructField(key, _SPARK_TYPES[kind]) for key, _, kind in WIRE_FIELDS])

# The typed edit: the wire record with a real timestamp and a list of flags.
EDIT = T.StructType(
    [
        T.StructField(
            column,
            {"ts": T.TimestampType(), "flags": T.ArrayType(T.StringType())}.get(
                column, _SPARK_TYPES[kind]
            ),
        )
        for _, column, kind in WIRE_FIELDS
    ]
)
EDIT_COLUMNS = EDIT.fieldNames()

CALENDAR_COLUMNS = [
    "year", "month", "week", "day", "hour", "minute", "weekday", "time", "day_minute",
]

STORED = T.StructType(
    EDIT.fields + [T.StructField(name, T.IntegerType()) for name in CALENDAR_COLUMNS]
)

# Upsert key of the stored table, in clustering order.
STORED_KEY = ["year", "month", "day", "time", "user", "id"]
STORED_PARTITIONS = ["year", "month", "day"]

BUS = T.StructType(
    [T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())]
)

# Frames as they are read: where they lie on the bus tells the order in which they came.
FRAMES = T.StructType(
    BUS.fields + [T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())]
)

# Year and week are those of ISO 8601: days around New Year may belong to the other year's weeks.
MODEL = T.StructType(
    [
        T.StructField("channel", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("week", T.IntegerType()),
        T.StructField("cluster", T.IntegerType()),
        T.StructField("centre", T.DoubleType()),
    ]
)

CATCH_ALL = "#all.wikipedia"
ALL_MESSAGES = "all-messages"
