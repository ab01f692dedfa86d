"""Parsing, typing and derivation of edits."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editflow.functions import text, validity
from editflow.functions.calendar import calendar_columns
from editflow.functions.generate import once
from editflow.schema import ALL_MESSAGES, EDIT_COLUMNS, WIRE_FIELDS

# Layout of a colour-coded change line. Fixed value.
IRC_LINE = (
    r"\x0314\[\[\x0307(.+?)\x0314\]\]\x034 (.*?)\x0310.*\x0302(http.+?)"
    r"\x03.+\x0303(.+?)\x03.+\x03 (\(([+-]\d+)\).*|.+) \x0310(.+)\x03"
)


def parse_irc(lines: DataFrame) -> DataFrame:
    """Column `raw` to page, flags, diff_url, user, delta and comment.

    Lines that do not match as a whole, or whose delta is beyond 64 bits, give no
    row. All groups come out of one match: the dot never matches a newline, so a
    newline is a safe separator between them.
    """
    groups = F.split(
        F.regexp_replace("raw", r"\A" + IRC_LINE + r"\z", "$1\n$2\n$3\n$4\n$6\n$7"), "\n", -1
    )
    single_line = ~F.contains("raw", F.lit("\n"))
    matched = once(lines, {"_g": F.when(single_line, groups)})
    page, flags, diff_url, user, size, comment = [F.get("_g", F.lit(i)) for i in range(6)]
    delta = size.try_cast("bigint")
    return matched.where((F.size("_g") == 6) & ((size == "") | delta.isNotNull())).select(
        *[c for c in lines.columns if c != "raw"],
        page.alias("page"),
        F.regexp_replace(flags, r"\s+", "").alias("flags"),
        diff_url.alias("diff_url"),
        user.alias("user"),
        F.coalesce(delta, F.lit(0)).alias("delta"),
        comment.alias("comment"),
    )


def derive_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {name: text.has_flag(F.col("flags"), letter) for name, letter in text.FLAG_LETTERS.items()}
    )


def derive_namespace(df: DataFrame) -> DataFrame:
    return df.withColumn("namespace", text.namespace_of(F.col("page")))


def derive_added_deleted(df: DataFrame) -> DataFrame:
    zero = F.lit(0).cast(df.schema["delta"].dataType)
    return df.withColumns(
        {"added": F.greatest("delta", zero), "deleted": -F.least("delta", zero)}
    )


def parse_json_edits(lines: DataFrame) -> DataFrame:
    """Column `raw` to the typed edit, with `_ok` false for a rejected line.

    Each of the 15 keys must be there with its JSON type; a number written as text
    or a boolean in quotes is a reject, as is a whole number beyond 32 bits.
    """
    kinds = {"string": "STRING", "boolean": "BOOLEAN", "int": "BIGINT"}
    fields = [(key, column, kind) for key, column, kind in WIRE_FIELDS if column != "id"]
    kept = [c for c in lines.columns if c not in EDIT_COLUMNS]
    values = lines.withColumn("_json", F.try_parse_json("raw")).select(
        *kept,
        *[F.try_variant_get("_json", f"$.{key}", "variant").alias(f"_{key}") for key, _, _ in fields],
    )
    typed = once(
        values,
        {
            column: F.when(
                F.schema_of_variant(f"_{key}") == kinds[kind],
                F.try_variant_get(f"_{key}", "$", kind),
            )
            for key, column, kind in fields
        },
    ).drop(*[f"_{key}" for key, _, _ in fields])
    return _checked(typed, F.lit(True))


def normalize_edits(df: DataFrame) -> DataFrame:
    """Wire record (camelCase columns) to the typed edit, with `_ok`."""
    kept = [c for c in df.columns if c not in [key for key, _, _ in WIRE_FIELDS]]
    renamed = df.select(*kept, *[F.col(key).alias(column) for key, column, _ in WIRE_FIELDS])
    identified = renamed.withColumn("id", F.lower("id"))
    return _checked(identified, validity.is_uuid(F.col("id")))


def _checked(df: DataFrame, valid: Column) -> DataFrame:
    """Timestamp text and flag text to their types, and `_ok` for a row without a fault."""
    present = F.coalesce(valid & validity.is_url(F.col("diff_url")), F.lit(False))
    for column in EDIT_COLUMNS:
        if column in df.columns and column != "ts":
            present = present & F.col(column).isNotNull()
    renamed = {"ts": "_written", "flags": "_flags"}
    typed = once(
        df.withColumn("_valid", present).withColumnsRenamed(renamed),
        {
            "ts": validity.to_instant(F.col("_written")),
            "flags": text.flags_to_list(F.col("_flags")),
        },
    )
    ok = F.col("_valid") & F.col("ts").isNotNull()
    return typed.withColumn("_ok", ok).drop("_valid", "_flags")


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejected rows of a frame with `_ok`.

    Both are filters over the same frame. Persist it first if both will be read.
    """
    return df.where("_ok").drop("_ok"), df.where(~F.col("_ok")).drop("_ok")


# The fields that a captured line holds; together they identify the line.
MESSAGE_COLUMNS = ["ts", "channel", "page", "flags", "diff_url", "user", "delta", "comment"]


def assign_id(df: DataFrame, mode: str = "content", columns: list[str] | None = None) -> DataFrame:
    """A UUID per edit: a hash of its content, so that a replay gives the same id, or random."""
    if mode == "random":
        return df.withColumn("id", F.uuid())
    parts = []
    for name in columns or MESSAGE_COLUMNS:
        kind = df.schema[name].dataType.typeName()
        column = F.col(name)
        if kind == "timestamp":
            column = F.unix_micros(column)
        elif kind == "array":
            column = text.flags_to_text(column)
        parts.append(F.coalesce(column.cast("string"), F.lit("")))
    digest = F.sha2(F.concat_ws("\u0003|", *parts), 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return df.withColumn("id", F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts]))


def split_flags(df: DataFrame) -> DataFrame:
    return df.withColumn("flags", text.flags_to_list(F.col("flags")))


def join_flags(df: DataFrame) -> DataFrame:
    return df.withColumn("flags", text.flags_to_text(F.col("flags")))


def calendar_fields(df: DataFrame, wall: str = "utc", written: str = "_written") -> DataFrame:
    """The nine calendar columns of `ts`.

    wall='utc' reads the clock of the session zone, UTC by default. wall='offset'
    reads the clock of the timestamp text in column `written`.
    """
    clock = F.col("ts") if wall == "utc" else validity.to_wall_clock(F.col(written))
    return df.withColumns(calendar_columns(clock))


def edit_from_row(df: DataFrame) -> DataFrame:
    """The edit of a stored row, without its calendar columns."""
    return df.select(*EDIT_COLUMNS)


def typed_edits(lines: DataFrame) -> DataFrame:
    """Raw lines to typed edits: parse, derive, identify. Deltas beyond 32 bits give no row."""
    edits = derive_added_deleted(derive_namespace(derive_flags(assign_id(parse_irc(lines)))))
    kept = [c for c in edits.columns if c not in EDIT_COLUMNS]
    in_range = F.abs(F.col("delta").cast("decimal(20,0)")) <= 2**31 - 1
    sizes = {c: F.col(c).cast("int") for c in ["added", "deleted", "delta"]}
    return split_flags(edits.where(in_range)).withColumns(sizes).select(*kept, *EDIT_COLUMNS)


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The lines of which typed_edits gives no row, with the reason."""
    size = F.regexp_extract("raw", r"\A" + IRC_LINE + r"\z", 6)
    matches = F.col("raw").rlike(r"\A" + IRC_LINE + r"\z") & ~F.contains("raw", F.lit("\n"))
    delta = size.try_cast("bigint")
    reason = (
        F.when(F.col("raw").isNull() | ~matches, "no change line")
        .when((size != "") & delta.isNull(), "delta beyond 64 bits")
        .when(F.abs(delta.cast("decimal(20,0)")) > 2**31 - 1, "delta beyond 32 bits")
    )
    return once(lines, {"reason": reason}).where("reason is not null")


def ui_feed(df: DataFrame) -> DataFrame:
    return df.select("user", F.col("page").alias("text"), F.col("ts").alias("timestamp"), "diff_url")


def metric_name(df: DataFrame) -> DataFrame:
    """Counter, anomaly and dashboard names; a row without channel counts all messages."""
    counter = F.coalesce(F.col("channel"), F.lit(ALL_MESSAGES))
    return df.withColumns(
        {
            "counter_name": counter,
            "anomaly_name": F.concat(F.col("channel"), F.lit("-anomaly")),
            "dashboard_name": F.regexp_replace(counter, "^#", ""),
        }
    )
