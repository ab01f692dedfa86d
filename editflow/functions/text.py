"""Column expressions on channels, flags, pages and metric names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flag letters. Fixed values.
FLAG_LETTERS = {"is_robot": "B", "is_minor": "M", "is_new": "N", "is_unpatrolled": "!"}


def channel_name(code: Column) -> Column:
    return F.concat(F.lit("#"), F.trim(code), F.lit(".wikipedia"))


def channel_code(channel: Column) -> Column:
    return F.regexp_extract(channel, r"\A#(.*)\.wikipedia\z", 1)


def has_flag(flags: Column, letter: str) -> Column:
    return F.contains(flags, F.lit(letter))


def namespace_of(page: Column) -> Column:
    """Text before the first colon, unless whitespace or nothing follows the colon."""
    prefix = F.regexp_extract(page, r"\A([^:]+):\S.*\z", 1)
    return F.when(prefix == "", "Main").otherwise(prefix)


def flags_to_list(flags: Column) -> Column:
    """Comma text to list: trailing empty items are dropped, '' is one empty item."""
    kept = F.rtrim(flags, F.lit(","))
    return (
        F.when(flags == "", F.array(F.lit("")))
        .when(kept == "", F.array().cast("array<string>"))
        .otherwise(F.split(kept, ",", -1))
    )


def flags_to_text(flags: Column) -> Column:
    return F.array_join(flags, ",")


def iso_millis(ts: Column) -> Column:
    """ISO text with milliseconds and offset, Z for UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
