"""One query per operator over the given tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.oracle import FEW, STEPS
from editflow.functions import text
from editflow.operators import counts, filters, joins, metrics, models, parse, series
from editflow.plans.jobs import train_and_score
from editflow.schema import BUS, CALENDAR_COLUMNS, EDIT_COLUMNS
from editflow.session import configure, materialize, scratch_path
from editflow.sources import bus, catalog, edits as edit_table, lines, log, models as model_table
from editflow.streaming import counting, feed, sinks, stateful

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(build(configure(spark), sf_dir))

    _QUERIES[build.__name__] = run
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps as microseconds and rounded doubles, so that both engines print the same."""
    shown = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.dataType.typeName() == "timestamp":
            column = F.unix_micros(column)
        elif field.dataType.typeName() == "double":
            column = F.round(column, 6)
        elif field.dataType.typeName() == "array":
            column = F.array_join(column, "|")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def _lines(spark, sf_dir):
    return fx.irc_lines(fx.events(spark, sf_dir))


def _records(spark, sf_dir):
    return parse.parse_json_edits(fx.json_records(fx.events(spark, sf_dir)))


def _hourly(spark, sf_dir):
    return counts.count_by_channel(fx.edits(spark, sf_dir), "1 hour")


def _profile(hourly: DataFrame) -> DataFrame:
    """Least, mean and greatest count of each channel, as its model."""
    stats = hourly.groupBy("channel").agg(
        F.array(
            F.min("n").cast("double"), F.sum("n").cast("double") / F.count("*"), F.max("n").cast("double")
        ).alias("centres")
    )
    profile = stats.select(
        "channel", F.lit(2024).alias("year"), F.lit(1).alias("week"), F.posexplode("centres").alias("cluster", "centre")
    )
    return materialize(profile, "profile")


def _weekly_profiles(hourly: DataFrame) -> DataFrame:
    """The same for each ISO week; one channel has a model of every other week only."""
    monday = F.trunc("bucket", "week")
    stats = hourly.groupBy("channel", monday.alias("monday")).agg(
        F.array(F.min("n").cast("double"), F.max("n").cast("double")).alias("centres")
    )
    week = F.weekofyear("monday")
    stats = stats.where((F.col("channel") != "#error.wikipedia") | (week % 2 == 0))
    return stats.select(
        "channel",
        F.extract(F.lit("YEAROFWEEK"), F.col("monday")).cast("int").alias("year"),
        week.alias("week"),
        F.posexplode("centres").alias("cluster", "centre"),
    )


def _edit_stream(spark, sf_dir, delay=fx.DELAY):
    return parse.typed_edits(fx.irc_lines(fx.event_stream(spark, sf_dir, delay)))


def _frames_on_disk(spark, frames: DataFrame) -> dict[str, str]:
    options = {"format": "parquet", "path": scratch_path(spark, "bus")}
    bus.write_bus(frames, options)
    return options


def _finish(started) -> None:
    started.awaitTermination()


def _as_text(frames: DataFrame) -> DataFrame:
    return frames.select(
        F.decode("key", "UTF-8").alias("key"), F.decode("value", "UTF-8").alias("value")
    )


def _with_flag_count(df: DataFrame) -> DataFrame:
    return df.withColumn("flag_count", F.size("flags"))


# Sources and sinks


@query
def read_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    _lines(spark, sf_dir).select("raw").write.text(path)
    return lines.read_lines(spark, path)


@query
def stream_lines(spark, sf_dir):
    path, out = scratch_path(spark, "lines"), scratch_path(spark, "out")
    _lines(spark, sf_dir).select("raw").write.text(path)
    stream = lines.stream_lines(spark, path, max_files=4)
    _finish(sinks.start(stream, sinks.batch_folder(out), scratch_path(spark, "offsets"), once=True))
    return spark.read.parquet(out).select("raw")


@query
def read_bus(spark, sf_dir):
    out = scratch_path(spark, "out")
    options = _frames_on_disk(spark, bus.encode_bus(fx.edits(spark, sf_dir)))
    decoded = bus.decode_bus(bus.read_bus(spark, options)).select(*EDIT_COLUMNS)
    _finish(sinks.start(decoded, sinks.batch_folder(out), scratch_path(spark, "offsets"), once=True))
    return spark.read.parquet(out).select(*EDIT_COLUMNS)


@query
def read_edits(spark, sf_dir):
    path = scratch_path(spark, "edits")
    edit_table.write_edits(fx.edits(spark, sf_dir), path)
    return edit_table.read_edits(
        spark, path, channel="#click.wikipedia", week=2, columns=["id", "weekday", "day_minute"]
    )


@query
def get_by_id(spark, sf_dir):
    edits = fx.edits(spark, sf_dir)
    wanted = edits.agg(F.min("id")).first()[0]
    return edit_table.get_by_id(edits, wanted).select(*EDIT_COLUMNS)


@query
def load_models(spark, sf_dir):
    path = scratch_path(spark, "models")
    trained = materialize(models.fit_all_models(fx.stored(spark, sf_dir), 1, FEW, "hour"), "trained")
    # Saved twice: the second time replaces the first.
    model_table.save_models(trained.withColumn("centre", -F.col("centre")), path)
    model_table.save_models(trained, path)
    return model_table.load_models(spark, path)


@query
def save_models(spark, sf_dir):
    path = scratch_path(spark, "models")
    model_table.save_models(models.fit_all_models(fx.stored(spark, sf_dir), 1, FEW, "hour"), path)
    return spark.read.parquet(path).select("channel", "year", "week", "cluster", "centre")


@query
def channel_catalog(spark, sf_dir):
    codes = fx.events(spark, sf_dir).select(F.col("event_type").alias("code")).distinct()
    return catalog.channel_catalog(spark, codes, with_all=True)


@query
def write_edits(spark, sf_dir):
    """Store all edits, then the robots' edits again with another comment."""
    path = scratch_path(spark, "edits")
    edits = materialize(fx.edits(spark, sf_dir), "parsed")
    edit_table.write_edits(edits, path, frozen=True)
    again = edits.where("is_robot").withColumn("comment", F.concat("comment", F.lit(" (again)")))
    edit_table.write_edits(again, path, frozen=True)
    return edit_table.read_edits(spark, path)


@query
def find_edit(spark, sf_dir):
    """The edit with the least id, from the files whose filters may hold it."""
    path = scratch_path(spark, "edits")
    edits = fx.edits(spark, sf_dir)
    edit_table.write_edits(edits, path)
    wanted = edits.agg(F.min("id")).first()[0]
    return edit_table.find_edit(spark, path, wanted).select(*EDIT_COLUMNS)


@query
def compact_edits(spark, sf_dir):
    """Days stored in five batches each, then merged; the rows stay, the files don't."""
    path = scratch_path(spark, "edits")
    edits = materialize(fx.edits(spark, sf_dir), "parsed")
    for part in range(5):
        edit_table.write_edits(edits.where(F.pmod(F.crc32("id"), F.lit(5)) == part), path)
    log.compact(spark, path, fan_in=4)
    return edit_table.read_edits(spark, path)


@query
def stored_total(spark, sf_dir):
    path = scratch_path(spark, "edits")
    edits = fx.edits(spark, sf_dir)
    edit_table.write_edits(edits, path)
    edit_table.write_edits(edits.where("is_robot"), path)
    return edit_table.stored_total(spark, path)


@query
def write_bus(spark, sf_dir):
    options = _frames_on_disk(spark, bus.encode_bus(fx.edits(spark, sf_dir)))
    return _as_text(spark.read.schema(BUS).parquet(options["path"]))


@query
def write_json_lines(spark, sf_dir):
    edits = fx.edits(spark, sf_dir)
    source, live = scratch_path(spark, "source"), scratch_path(spark, "live")
    lines.write_json_lines(edits, source, "source")
    lines.write_json_lines(edits, live, "live")

    def field(name):
        return F.get_json_object("raw", f"$.{name}")

    from_source = lines.read_lines(spark, source).select(
        field("diffUrl").alias("diff_url"),
        field("timestamp").alias("source_timestamp"),
        field("channel").alias("channel"),
        field("page").alias("page"),
        field("flags").alias("flags"),
        field("user").alias("user"),
        field("delta").alias("delta"),
        field("added").alias("added"),
        field("deleted").alias("deleted"),
        field("comment").alias("comment"),
        field("isRobot").alias("is_robot"),
        field("namespace").alias("namespace"),
        F.json_object_keys("raw").alias("_keys"),
    )
    from_live = lines.read_lines(spark, live).select(
        field("diffUrl").alias("diff_url"),
        field("id").alias("id"),
        field("timestamp").cast("bigint").alias("live_millis"),
        field("flags").alias("live_flags"),
        F.size(F.json_object_keys("raw")).alias("live_keys"),
    )
    joined = from_source.join(from_live, "diff_url")
    return joined.withColumn("source_keys", F.size("_keys")).drop("_keys")


@query
def write_metrics(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    model_table.write_metrics(counts.count_rollup(fx.edits(spark, sf_dir), "10 seconds"), path)
    return spark.read.parquet(path)


@query
def fan_out(spark, sf_dir):
    out = scratch_path(spark, "fan")

    def record(name, build):
        def sink(batch, batch_id):
            seen = build(batch).agg(F.count("*").alias("seen"))
            seen.select(F.lit(name).alias("sink"), "seen").write.mode("append").parquet(out)

        return sink

    sinks.fan_out(
        _records(spark, sf_dir),
        [
            record("sampled", lambda b: filters.every_nth(b, 50, order=["event_id"])),
            record("counted", lambda b: b),
            record("published", lambda b: parse.split_rejects(b)[0]),
        ],
    )
    return spark.read.parquet(out)


# Projections


@query
def parse_irc(spark, sf_dir):
    return parse.parse_irc(_lines(spark, sf_dir))


@query
def derive_flags(spark, sf_dir):
    return parse.derive_flags(parse.parse_irc(_lines(spark, sf_dir))).select(
        "event_id", *text.FLAG_LETTERS
    )


@query
def derive_namespace(spark, sf_dir):
    return parse.derive_namespace(parse.parse_irc(_lines(spark, sf_dir))).select(
        "event_id", "page", "namespace"
    )


@query
def derive_added_deleted(spark, sf_dir):
    return parse.derive_added_deleted(parse.parse_irc(_lines(spark, sf_dir))).select(
        "event_id", "delta", "added", "deleted"
    )


_RECORD_COLUMNS = [c for c in EDIT_COLUMNS if c != "id"] + ["flag_count"]


@query
def parse_json_edits(spark, sf_dir):
    good = _records(spark, sf_dir).where("_ok")
    return _with_flag_count(good).select("event_id", *_RECORD_COLUMNS)


@query
def split_rejects(spark, sf_dir):
    good, bad = parse.split_rejects(_records(spark, sf_dir))
    return good.select("event_id", F.lit("good").alias("side")).union(
        bad.select("event_id", F.lit("bad"))
    )


@query
def assign_id(spark, sf_dir):
    return parse.assign_id(parse.parse_irc(_lines(spark, sf_dir))).select("event_id", "id")


@query
def split_flags(spark, sf_dir):
    good, _ = parse.split_rejects(_records(spark, sf_dir))
    written = fx.json_records(fx.events(spark, sf_dir)).select(
        "event_id", F.get_json_object("raw", "$.flags").alias("flags")
    )
    split = parse.split_flags(written).join(good.select("event_id"), "event_id")
    return _with_flag_count(split)


@query
def join_flags(spark, sf_dir):
    good, _ = parse.split_rejects(_records(spark, sf_dir))
    return parse.join_flags(good).select("event_id", "flags")


@query
def normalize_edits(spark, sf_dir):
    frames = bus.encode_bus(fx.edits(spark, sf_dir))
    wire = frames.select(F.from_json(F.decode("value", "UTF-8"), bus.WIRE).alias("w")).select("w.*")
    return parse.normalize_edits(wire).withColumnRenamed("_ok", "ok").drop("_written")


@query
def calendar_fields(spark, sf_dir):
    utc = fx.stored(spark, sf_dir).withColumn("clock", F.lit("utc"))
    good, _ = parse.split_rejects(_records(spark, sf_dir))
    offset = parse.calendar_fields(good, wall="offset").withColumn("clock", F.lit("offset"))
    shown = ["event_id", "clock", *CALENDAR_COLUMNS]
    return utc.select(*shown).union(offset.select(*shown))


@query
def encode_bus(spark, sf_dir):
    return _as_text(bus.encode_bus(fx.edits(spark, sf_dir)))


@query
def decode_bus(spark, sf_dir):
    good, _ = parse.split_rejects(bus.decode_bus(bus.encode_bus(fx.edits(spark, sf_dir))))
    return good.select(*EDIT_COLUMNS)


@query
def edit_from_row(spark, sf_dir):
    return parse.edit_from_row(fx.stored(spark, sf_dir))


@query
def channel_name(spark, sf_dir):
    named = fx.events(spark, sf_dir).select(
        "event_id", text.channel_name(F.col("event_type")).alias("channel")
    )
    return named.withColumn("code", text.channel_code(F.col("channel")))


@query
def ui_feed(spark, sf_dir):
    return parse.ui_feed(fx.edits(spark, sf_dir))


@query
def metric_name(spark, sf_dir):
    edits = fx.edits(spark, sf_dir)
    both = edits.groupBy("channel").count().groupingSets([["channel"], []], "channel").agg(
        F.sum("count").alias("n")
    )
    return parse.metric_name(both).select("counter_name", "anomaly_name", "dashboard_name")


# Filters


@query
def filter_channel(spark, sf_dir):
    return filters.filter_channel(fx.edits(spark, sf_dir), "#View.wikipedia").select(*EDIT_COLUMNS)


@query
def filter_week(spark, sf_dir):
    return filters.filter_week(fx.stored(spark, sf_dir), 3).select("id", "year", "week")


@query
def sample_metrics(spark, sf_dir):
    rows = fx.metric_events(fx.events(spark, sf_dir))
    return filters.sample_metrics(rows, 0.3, seed=42).select("event_id", "name", "rate")


@query
def every_nth(spark, sf_dir):
    return filters.every_nth(fx.edits(spark, sf_dir), 50).select("id", "position")


@query
def recent_window(spark, sf_dir):
    return filters.recent_window(fx.edits(spark, sf_dir)).select("id", "ts")


# Joins


@query
def attach_model(spark, sf_dir):
    hourly = _hourly(spark, sf_dir)
    some = _profile(hourly).where(F.col("channel") != "#error.wikipedia")  # one channel has no model
    return joins.attach_model(hourly, some).select(
        "bucket",
        "channel",
        "n",
        "model_week",
        F.array_min("centres.centre").alias("least_centre"),
        F.array_max("centres.centre").alias("greatest_centre"),
    )


@query
def attach_model_before(spark, sf_dir):
    """Each count with the model of the last week that was over then."""
    hourly = _hourly(spark, sf_dir)
    found = joins.attach_model(hourly, _weekly_profiles(hourly), when="before")
    return found.select(
        "bucket",
        "channel",
        "n",
        "model_year",
        "model_week",
        F.array_min("centres.centre").alias("least_centre"),
        F.array_max("centres.centre").alias("greatest_centre"),
    )


@query
def nearest_centroid(spark, sf_dir):
    hourly = _hourly(spark, sf_dir)
    return joins.nearest_centroid(hourly, _profile(hourly))


@query
def score_distance(spark, sf_dir):
    hourly = _hourly(spark, sf_dir)
    placed = joins.nearest_centroid(hourly, _profile(hourly)).drop("distance")
    return models.score_distance(placed).select("bucket", "channel", "distance")


@query
def route_edits(spark, sf_dir):
    routed = joins.route_edits(fx.edits(spark, sf_dir), fx.subscriptions(spark))
    return routed.select("subscriber", "id", "channel")


# Counts


@query
def count_all(spark, sf_dir):
    return counts.count_all(fx.edits(spark, sf_dir))


@query
def count_by_channel(spark, sf_dir):
    return counts.count_by_channel(fx.edits(spark, sf_dir))


@query
def count_rollup(spark, sf_dir):
    return counts.count_rollup(fx.edits(spark, sf_dir))


@query
def count_matching(spark, sf_dir):
    return counts.count_matching(
        fx.edits(spark, sf_dir), "robot-edits", F.col("is_robot"), "60 seconds", start=2
    )


@query
def count_items(spark, sf_dir):
    return counts.count_items(_records(spark, sf_dir))


@query
def inserted_total(spark, sf_dir):
    return counts.inserted_total(fx.edits(spark, sf_dir))


@query
def weekly_minute_counts(spark, sf_dir):
    return counts.weekly_minute_counts(fx.stored(spark, sf_dir), "#click.wikipedia", 2)


@query
def count_vectors(spark, sf_dir):
    cells = counts.weekly_minute_counts(fx.stored(spark, sf_dir), "#click.wikipedia", 2)
    return counts.count_vectors(cells)


@query
def anomaly_counts(spark, sf_dir):
    hourly = _hourly(spark, sf_dir)
    scored = models.detect_anomalies(hourly, _profile(hourly))
    return counts.anomaly_counts(scored, "1 day")


@query
def clustering_score(spark, sf_dir):
    hourly = _hourly(spark, sf_dir)
    return models.clustering_score(hourly, _profile(hourly))


# Metrics


def _metrics(spark, sf_dir):
    return fx.metric_events(fx.events(spark, sf_dir))


@query
def metric_counter(spark, sf_dir):
    return metrics.metric_counter(_metrics(spark, sf_dir), "1 hour")


@query
def metric_gauge(spark, sf_dir):
    return metrics.metric_gauge(_metrics(spark, sf_dir), "1 hour", value="setting")


@query
def metric_set(spark, sf_dir):
    return metrics.metric_set(_metrics(spark, sf_dir), "1 hour")


@query
def metric_timing(spark, sf_dir):
    return metrics.metric_timing(_metrics(spark, sf_dir), "1 day")


@query
def metric_timing_fractions(spark, sf_dir):
    """Samples with fractions, nearly all of them different and close together."""
    rows = _metrics(spark, sf_dir).withColumn("kind", F.lit("ms"))
    return metrics.metric_timing(rows, "1 day", value="millis")


@query
def metric_sketches(spark, sf_dir):
    """Sketches per hour, merged to weeks: exact figures, and whether the others keep to their error."""
    rows = materialize(_metrics(spark, sf_dir), "metrics")
    merged = metrics.merged_sketches(metrics.metric_sketches(rows, "1 hour", "millis"), "7 days")
    found = metrics.sketch_values(merged, [0.5, 0.9])
    keys = ["bucket", "name", "kind"]
    exact = rows.withColumn("bucket", F.window("ts", "7 days")["start"]).join(found, keys)
    near = F.abs(F.max("unique") - F.count_distinct("millis")) <= 5 * metrics.UNIQUE_ERROR * F.max("unique") + 1
    for p in (50, 90):  # the wanted rank lies, within the error, between the ranks of the found value
        below, upto = F.count_if(F.col("millis") < F.col(f"p{p}")), F.count_if(F.col("millis") <= F.col(f"p{p}"))
        error = 2 * metrics.RANK_ERROR
        inside = (below / F.count("*") <= p / 100 + error) & (upto / F.count("*") >= p / 100 - error)
        near = F.when(F.first("kind") == "ms", inside).otherwise(near)
    checked = exact.groupBy(*keys).agg(near.alias("near"))
    shown = [F.round(F.col(c), 6).alias(c) for c in ("least", "greatest", "mean")]
    return found.join(checked, keys).select(*keys, "samples", *shown, "near")


@query
def metric_lines(spark, sf_dir):
    return metrics.metric_lines(_metrics(spark, sf_dir)).select("event_id", "line")


# Series


@query
def zero_fill(spark, sf_dir):
    return series.zero_fill(_hourly(spark, sf_dir), "1 hour")


@query
def moving_average(spark, sf_dir):
    return series.moving_average(_hourly(spark, sf_dir))


@query
def running_count(spark, sf_dir):
    return series.running_count(fx.edits(spark, sf_dir).select("id", "ts", "channel")).drop("ts")


@query
def latest_n(spark, sf_dir):
    return series.latest_n(fx.edits(spark, sf_dir)).select("id", "channel", "recency")


@query
def clustering_order(spark, sf_dir):
    ordered = series.clustering_order(fx.stored(spark, sf_dir))
    return ordered.select("id", "year", "month", "day", "time", "user")


# Models


@query
def fit_channel_model(spark, sf_dir):
    return models.fit_channel_model(fx.stored(spark, sf_dir), "#click.wikipedia", 1)


@query
def fit_all_models(spark, sf_dir):
    return models.fit_all_models(fx.stored(spark, sf_dir), 1)


@query
def fit_few_clusters(spark, sf_dir):
    return models.fit_all_models(fx.stored(spark, sf_dir), 1, FEW, "hour")


@query
def fit_models_stepwise(spark, sf_dir):
    return models.fit_models_stepwise(fx.stored(spark, sf_dir), 1, FEW, STEPS, grain="hour")


@query
def detect_anomalies(spark, sf_dir):
    return train_and_score(_lines(spark, sf_dir), 1)


@query
def detect_anomalies_few(spark, sf_dir):
    return train_and_score(_lines(spark, sf_dir), 1, FEW)


# Streaming


@query
def stream_counts(spark, sf_dir):
    out = scratch_path(spark, "out")
    stream = counting.stream_counts(_edit_stream(spark, sf_dir), "1 hour", fx.WATERMARK)
    _finish(sinks.start(stream, sinks.batch_folder(out), scratch_path(spark, "offsets"), once=True))
    return spark.read.parquet(out).select("bucket", "channel", "n")


@query
def stream_tallies(spark, sf_dir):
    """Events nine days late, far beyond the watermark, and intervals without any."""
    out = scratch_path(spark, "out")
    edits = _edit_stream(spark, sf_dir, fx.LONG_DELAY)
    tallies = stateful.stream_tallies(
        edits, "30 minutes", fx.WATERMARK, start=2, predicate=F.col("is_robot"), totals=True
    )
    _finish(sinks.start(tallies, sinks.batch_folder(out), scratch_path(spark, "offsets"), once=True))
    return stateful.settled(spark.read.parquet(out))


@query
def stream_gauges(spark, sf_dir):
    """Gauges whose events come up to nine days late; what the batches change is settled at the end."""
    out = scratch_path(spark, "out")
    rows = fx.metric_events(fx.event_stream(spark, sf_dir, fx.LONG_DELAY))
    changes = stateful.stream_gauges(rows, "1 hour", "setting")
    _finish(sinks.start(changes, sinks.batch_folder(out), scratch_path(spark, "offsets"), once=True))
    return stateful.gauge_values(spark.read.parquet(out))


@query
def stream_latest(spark, sf_dir):
    out = scratch_path(spark, "out")
    changes = feed.stream_latest(_edit_stream(spark, sf_dir, fx.LONG_DELAY).select("id", "ts", "channel"))
    _finish(sinks.start(changes, sinks.batch_folder(out), scratch_path(spark, "offsets"), once=True))
    return feed.latest_messages(spark.read.parquet(out)).select("id", "channel", "recency")


@query
def stream_numbered(spark, sf_dir):
    out = scratch_path(spark, "out")
    edits = _edit_stream(spark, sf_dir, "0 minutes").select("id", "ts", "channel")
    _finish(feed.stream_numbered(edits, out, scratch_path(spark, "offsets"), once=True))
    return spark.read.parquet(f"{out}/rows").select("id", "channel", "message_number")


@query
def stream_every_nth(spark, sf_dir):
    out = scratch_path(spark, "out")
    edits = _edit_stream(spark, sf_dir, "0 minutes").select("id", "ts", "channel")
    numbered = feed.stream_numbered(edits, out, scratch_path(spark, "offsets"), (), out="nth", every=50, once=True)
    _finish(numbered)
    return spark.read.parquet(f"{out}/rows").select("id", (F.col("nth") - 1).alias("position"))


@query
def stream_once(spark, sf_dir):
    """Frames of which a third come again, in later batches: stored once and counted once."""
    path, out = scratch_path(spark, "edits"), scratch_path(spark, "counts")
    edits = fx.edits(spark, sf_dir).withColumn("third", F.pmod(F.crc32("id"), F.lit(3)))
    encoded = materialize(bus.encode_bus(edits, keep=["third"]), "encoded")
    options = {"format": "parquet", "path": scratch_path(spark, "bus")}
    files = max(2, encoded.count() // 3 // fx.ROWS_PER_FILE)
    for part in (encoded.where("third = 0"), encoded.where("third <= 1"), encoded):
        bus.write_bus(part.drop("third").repartition(files), options)
    frames = bus.read_bus(spark, options | {"maxFilesPerTrigger": str(files)})
    counted = sinks.stream_once(
        frames, path, scratch_path(spark, "offsets"), [sinks.count_sink(out, "1 hour")], once=True
    )
    _finish(counted)
    return stateful.settled(spark.read.parquet(out))


@query
def stream_score(spark, sf_dir):
    out = scratch_path(spark, "out")
    stream = counting.stream_counts(_edit_stream(spark, sf_dir), "1 hour", fx.WATERMARK)
    profile = _profile(_hourly(spark, sf_dir))
    offsets = scratch_path(spark, "offsets")
    _finish(sinks.stream_score(stream, profile, out, offsets, "1 hour", once=True))
    scored = spark.read.parquet(f"{out}/scored")
    return scored.select("bucket", "channel", "n", "cluster", "centre", "is_anomaly")


@query
def stream_store(spark, sf_dir):
    """Frames in several batches; those of the first days come a second time."""
    path = scratch_path(spark, "edits")
    edits = fx.edits(spark, sf_dir)
    options = {"format": "parquet", "path": scratch_path(spark, "bus")}
    edits = materialize(edits, "edits")
    files = max(2, edits.count() // 3 // fx.ROWS_PER_FILE)
    third = F.pmod(F.crc32("id"), F.lit(3))
    parts = [edits.where(third == i) for i in range(3)] + [edits.where(F.dayofmonth("ts") <= 5)]
    for part in parts:
        bus.write_bus(bus.encode_bus(part).repartition(files), options)
    frames = bus.read_bus(spark, options | {"maxFilesPerTrigger": str(files)})
    _finish(sinks.stream_store(frames, path, scratch_path(spark, "offsets"), once=True, compact_every=3))
    return edit_table.read_edits(spark, path)


@query
def stream_ingest(spark, sf_dir):
    out = scratch_path(spark, "bus")
    parsed = parse.parse_json_edits(fx.json_records(fx.event_stream(spark, sf_dir)))
    identified = parse.assign_id(parsed)
    offsets = scratch_path(spark, "offsets")
    _finish(sinks.stream_ingest(identified, sinks.batch_folder(out), offsets, once=True))
    good, _ = parse.split_rejects(bus.decode_bus(spark.read.schema(BUS).parquet(out)))
    return _with_flag_count(good).select(*_RECORD_COLUMNS)


@query
def dedupe_redelivery(spark, sf_dir):
    edits = fx.edits(spark, sf_dir).select(*EDIT_COLUMNS)
    return counting.dedupe_redelivery(edits.union(edits), ["id"])


@query
def total_messages(spark, sf_dir):
    out = scratch_path(spark, "out")
    totals = counting.total_messages(_edit_stream(spark, sf_dir))
    offsets = scratch_path(spark, "offsets")
    _finish(sinks.start(totals, sinks.batch_folder(out), offsets, once=True, mode="complete"))
    reported = spark.read.parquet(out)
    newest = reported.select(F.max("batch")).scalar()
    return reported.where(F.col("batch") == newest).select("name", "n")


@query
def on_flush(spark, sf_dir):
    """The callback stores the counts and then fails, which the query survives."""
    out = scratch_path(spark, "out")
    store = sinks.batch_folder(out)

    def flush(batch, batch_id):
        store(batch, batch_id)
        raise ValueError("raised after the counts were stored")

    stream = counting.stream_counts(_edit_stream(spark, sf_dir), "1 hour", fx.WATERMARK)
    _finish(sinks.on_flush(stream, flush, scratch_path(spark, "offsets"), once=True))
    return spark.read.parquet(out).select("bucket", "channel", "n")


@query
def for_each_edit(spark, sf_dir):
    out = scratch_path(spark, "out")
    stream = _edit_stream(spark, sf_dir).select(*EDIT_COLUMNS)
    offsets = scratch_path(spark, "offsets")
    _finish(sinks.for_each_edit(stream, sinks.batch_folder(out), offsets, once=True))
    return spark.read.parquet(out).select(*EDIT_COLUMNS)
