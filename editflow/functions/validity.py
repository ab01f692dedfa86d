"""Checks of text that must hold a timestamp, a URL or a UUID."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain cast also takes 'T10' (today at ten) and a blank between date and time.
_ISO = (
    r"\A\d{4}(-\d{2}(-\d{2}(T\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?(Z|[+-]\d{2}:?\d{2})?)?)?)?\z"
)
_SHORT_TIME = r"(T\d{2}:\d{2})(Z|[+-]\d{2}:?\d{2})\z"
_URL = r"\A(?i:https?|ftp|file|jar|mailto):"
_BAD_PORT = r"\A[^:]+://[^/?#@\[]*:\d*[^/?#\d]"
_UUID = r"\A[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\z"


def iso_text(text: Column) -> Column:
    """The text if it is an ISO date and time, in a form that a cast takes; else null."""
    full = F.regexp_replace(F.translate(text, ",", "."), _SHORT_TIME, "$1:00$2")
    return F.when(text.rlike(_ISO), full)


def to_instant(text: Column) -> Column:
    return iso_text(text).try_cast("timestamp")


def to_wall_clock(text: Column) -> Column:
    """The clock reading as written, whatever its offset."""
    return iso_text(text).try_cast("timestamp_ntz")


def is_url(text: Column) -> Column:
    return text.rlike(_URL) & ~text.rlike(_BAD_PORT)


def is_uuid(text: Column) -> Column:
    return text.rlike(_UUID)
