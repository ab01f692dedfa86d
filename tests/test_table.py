"""The stored table, lines, bus, models and catalog."""

import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.queries import queries
from editflow.functions.calendar import months_of_week
from editflow.operators.parse import split_rejects
from editflow.schema import BUS, EDIT_COLUMNS, MODEL, STORED, STORED_KEY
from editflow.session import checkpoint_root
from editflow.sources import bus, catalog, edits as table, lines, log, models as model_table
from tests.data import edit_frame, wire_frame


def stored(spark, path):
    return table.read_edits(spark, path)


def file_names(spark, path):
    return set(log.names_of(log.files(spark, path, log.latest(spark, path))))


def event_rows(spark):
    """Sixty events of one type; the lines of two of them are no edits."""
    at = F.timestamp_seconds(1_704_067_200 + F.col("id") * 7_000).cast("timestamp_ntz")
    return spark.range(60).select(
        F.col("id").alias("event_id"), at.alias("ts"), (F.col("id") % 7).alias("user_id"),
        F.lit("click").alias("event_type"), F.lit(2.5).alias("value"), F.lit("{}").alias("props"),
    )


def rows(df):
    return sorted(map(tuple, df.select(*EDIT_COLUMNS).collect()), key=repr)


def test_absent_before_present_after(spark, folder):
    path = folder("edits")
    edits = edit_frame(spark, 60)
    table.write_edits(edits.limit(30), path)
    one = edits.join(stored(spark, path).select("id"), "id", "left_anti").first()
    assert table.get_by_id(stored(spark, path), one.id).count() == 0
    table.write_edits(edits, path)
    found = table.get_by_id(stored(spark, path), one.id).select(*EDIT_COLUMNS).collect()
    assert [tuple(r) for r in found] == [tuple(one[c] for c in EDIT_COLUMNS)]


def test_upsert_is_idempotent_and_the_last_write_wins(spark, folder):
    path = folder("edits")
    edits = edit_frame(spark, 200)
    for _ in range(3):
        table.write_edits(edits, path)
    assert rows(stored(spark, path)) == rows(edits)
    changed = edits.where("is_robot").withColumn("comment", F.lit("again"))
    table.write_edits(changed, path)
    expected = edits.where(~F.col("is_robot")).union(changed)
    assert rows(stored(spark, path)) == rows(expected)


def test_keep_leaves_the_stored_row(spark, folder):
    path = folder("edits")
    edits = edit_frame(spark, 100)
    table.write_edits(edits.limit(50), path)
    table.write_edits(edits.withColumn("comment", F.lit("again")), path, on_conflict="keep")
    kept = stored(spark, path)
    assert kept.count() == 100
    assert kept.where("comment = 'again'").count() == 50


def test_newest_copy_of_a_batch_wins(spark, folder):
    path = folder("edits")
    edit = edit_frame(spark, 1)
    copies = edit
    for millis in range(1, 6):
        later = F.col("ts") + F.expr(f"interval {millis} milliseconds")
        copies = copies.union(edit.withColumns({"ts": later, "comment": F.lit(str(millis))}))
    table.write_edits(copies, path)
    assert [r.comment for r in stored(spark, path).collect()] == ["5"]


def test_only_files_that_hold_a_key_are_rewritten(spark, folder):
    path = folder("edits")
    edits = edit_frame(spark, 300)
    half = F.crc32("id") % 2 == 0
    table.write_edits(edits.where(half), path)
    table.write_edits(edits.where(~half), path)
    before = file_names(spark, path)
    one = spark.createDataFrame([stored(spark, path).first()], STORED).withColumn("comment", F.lit("again"))
    table.write_edits(one.select(*EDIT_COLUMNS), path)
    after = file_names(spark, path)
    assert len(before - after) == 1 and len(after - before) == 1
    day = one.first().asDict()
    assert f"year={day['year']}/month={day['month']}/day={day['day']}/" in (before - after).pop()
    assert stored(spark, path).count() == 300 and stored(spark, path).where("comment = 'again'").count() == 1


def test_filters_choose_the_files_that_are_opened(spark, folder, monkeypatch):
    path = folder("edits")
    edits = edit_frame(spark, 400)
    for part in range(4):
        table.write_edits(edits.where(F.crc32("id") % 4 == part), path)
    live = log.files(spark, path, log.latest(spark, path))
    total, ids = live.count(), [r.id for r in edits.collect()]
    for wanted in ids[:3]:
        held = log.names_of(live.where(log.may_hold(F.lit(wanted), F.col("bloom"))))
        inside = log.read_files(spark, path, held).where(F.col("id") == wanted).select("_file").collect()
        assert len(inside) == 1 and len(held) <= 1 + total // 10
        assert table.find_edit(spark, path, wanted).count() == 1
    assert table.find_edit(spark, path, "no such id").count() == 0
    # No false negatives, and few others.
    pairs = spark.createDataFrame([(i,) for i in ids], "id string").crossJoin(live.select("file", "bloom"))
    taken = pairs.where(log.may_hold(F.col("id"), F.col("bloom"))).count()
    assert 400 <= taken < 400 + 400 * total / 25
    opened = []
    read = log.read_files
    monkeypatch.setattr(log, "read_files", lambda s, p, names: opened.append(names) or read(s, p, names))
    fresh = edits.limit(5).withColumn("id", F.concat(F.lit("new"), "id"))
    table.write_edits(fresh, path)
    assert len(opened[0]) <= 2  # files of five keys that no file holds


@pytest.mark.parametrize("few", [0, 1_000_000])
@pytest.mark.parametrize("on_conflict", ["replace", "keep"])
def test_many_and_few_keys_give_the_same_rows(spark, folder, monkeypatch, on_conflict, few):
    """Keys that are stored, come twice, are new or hold a null, sent to each task or moved."""
    monkeypatch.setattr(table, "FEW_KEYS", few)
    path = folder("edits")
    edits = edit_frame(spark, 120).localCheckpoint()
    nameless = edits.where(F.crc32("id") % 5 == 0).withColumn("user", F.lit(None).cast("string"))
    named = edits.where(F.crc32("id") % 5 != 0)
    old, late = F.crc32("id") % 2 == 0, F.col("ts") + F.expr("interval 1 microsecond")
    table.write_edits(named.where(old).unionByName(nameless), path)
    mine = named.unionByName(nameless).withColumn("comment", F.lit("mine"))
    copies = mine.where(F.crc32("id") % 3 == 0).withColumns({"ts": late, "comment": F.lit("copy")})
    table.write_edits(mine.unionByName(copies), path, on_conflict=on_conflict)
    newest = mine.where(F.crc32("id") % 3 != 0).unionByName(copies)
    expected = newest if on_conflict == "replace" else newest.where(~old).unionByName(named.where(old))
    # A key with a null is equal to no stored one, so its edits are there twice.
    expected = expected.where("user is not null").unionByName(nameless).unionByName(newest.where("user is null"))
    assert rows(stored(spark, path)) == rows(expected)


def test_only_copies_are_sorted_for_the_newest(spark, folder, monkeypatch):
    seen, latest = [], table.latest_per_key
    monkeypatch.setattr(table, "latest_per_key", lambda df: seen.append(df.count()) or latest(df))
    edits, path = edit_frame(spark, 200), folder("edits")
    table.write_edits(edits, path)
    assert seen == []
    ids = sorted(r.id for r in edits.select("id").collect())
    table.write_edits(edits.unionByName(edits.where(F.col("id") <= ids[2])), path)
    assert seen == [6]  # three edits that come twice
    assert rows(stored(spark, path)) == rows(edits)


@pytest.mark.parametrize("keep", [False, True])
def test_stored_rows_and_a_batch_are_moved_once(spark, folder, keep):
    path = folder("edits")
    table.write_edits(edit_frame(spark, 50), path)
    batch = stored(spark, path)
    plan = table._merged(batch, batch.select(*STORED_KEY) if keep else batch, keep)
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan and "Join" not in plan


def test_a_frozen_frame_is_not_copied(spark, folder, monkeypatch):
    labels, copy = [], table.materialize
    monkeypatch.setattr(table, "materialize", lambda df, label: labels.append(label) or copy(df, label))
    edits, path = edit_frame(spark, 30), folder("edits")
    table.write_edits(edits, path, frozen=True)
    assert "batch" not in labels
    table.write_edits(edits, path)
    assert "batch" in labels
    assert rows(stored(spark, path)) == rows(edits)


def test_lines_are_parsed_once(spark, folder, monkeypatch):
    """What compact_edits stores in five parts is parsed before, not again by each write."""
    tables = folder("tables")
    at = F.timestamp_seconds(1_704_067_200 + F.col("id") * 7_000).cast("timestamp_ntz")
    spark.range(60).select(
        F.col("id").alias("event_id"), at.alias("ts"), (F.col("id") % 7).alias("user_id"),
        F.lit("click").alias("event_type"), F.lit(2.5).alias("value"), F.lit("{}").alias("props"),
    ).write.parquet(f"{tables}/events.parquet")
    plans, write = [], table.write_edits

    def seen(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, *args, **kwargs)

    monkeypatch.setattr(table, "write_edits", seen)
    assert queries()["compact_edits"](spark, tables).count() == 58
    assert len(plans) == 5 and not any("regexp" in plan for plan in plans)


def test_write_edits_parses_lines_once(spark, folder, monkeypatch):
    """Both writes read what was parsed before, as it is."""
    tables, seen, write = folder("tables"), [], table.write_edits
    event_rows(spark).write.parquet(f"{tables}/events.parquet")

    def noted(df, *args, **kwargs):
        seen.append(("regexp" in df._jdf.queryExecution().optimizedPlan().toString(), kwargs))
        write(df, *args, **kwargs)

    monkeypatch.setattr(table, "write_edits", noted)
    assert queries()["write_edits"](spark, tables).count() == 58
    assert seen == [(False, {"frozen": True})] * 2


def test_stream_once_encodes_frames_once(spark, folder, monkeypatch):
    tables, plans, write = folder("tables"), [], bus.write_bus
    event_rows(spark).write.parquet(f"{tables}/events.parquet")

    def noted(frames, options):
        plans.append(frames._jdf.queryExecution().optimizedPlan().toString())
        return write(frames, options)

    monkeypatch.setattr(bus, "write_bus", noted)
    counted = queries()["stream_once"](spark, tables)
    assert sum(r["n"] for r in counted.collect()) == 2 * 58  # its channel, and all
    assert len(plans) == 3 and not any("to_json" in p or "regexp" in p for p in plans)


def test_encoded_frames_keep_columns(spark):
    edits = edit_frame(spark, 20).withColumn("part", F.crc32("id") % 3)
    frames = bus.encode_bus(edits, keep=["part"])
    assert frames.columns == ["part", "key", "value"]
    parts = bus.decode_bus(frames).select("part", F.crc32("id") % 3).collect()
    assert len(parts) == 20 and all(a == b for a, b in parts)


def test_readers_keep_their_version(spark, folder):
    path = folder("edits")
    edits = edit_frame(spark, 80)
    table.write_edits(edits, path)
    before = table.read_edits(spark, path)
    table.write_edits(edits.withColumn("comment", F.lit("again")), path)
    assert before.where("comment = 'again'").count() == 0 and before.count() == 80
    assert rows(table.read_edits(spark, path, version=0)) == rows(edits)
    assert stored(spark, path).where("comment = 'again'").count() == 80
    assert log.vacuum(spark, path, keep=1) > 0
    assert stored(spark, path).where("comment = 'again'").count() == 80
    assert table.stored_total(spark, path).first().n == 80


@pytest.mark.parametrize("on_conflict", ["replace", "keep"])
def test_two_writers(spark, folder, monkeypatch, on_conflict):
    """Another writer makes a version while this one works; both writes are there."""
    path = folder("edits")
    edits = edit_frame(spark, 90)
    table.write_edits(edits.limit(30), path)
    mine, commit, calls = edits.withColumn("comment", F.lit("mine")), log.commit, []

    def meanwhile(*args):
        calls.append(1)
        if len(calls) == 1:
            table.write_edits(edits.withColumn("comment", F.lit("theirs")), path)
        return commit(*args)

    with monkeypatch.context() as patched:
        patched.setattr(log, "commit", meanwhile)
        table.write_edits(mine, path, on_conflict=on_conflict)
    assert len(calls) == 3  # mine in vain, theirs, mine again
    expected = mine if on_conflict == "replace" else edits.withColumn("comment", F.lit("theirs"))
    assert rows(stored(spark, path)) == rows(expected)
    assert log.latest(spark, path).number == 2


def test_a_writer_that_never_wins_gives_up(spark, folder, monkeypatch):
    path = folder("edits")
    monkeypatch.setattr(log, "TRIES", 2)
    monkeypatch.setattr(log, "commit", lambda *args: None)
    with pytest.raises(log.Conflict, match="2 versions"):
        table.write_edits(edit_frame(spark, 5), path)


@pytest.mark.parametrize("step", ["holding", "read_files", "add_files", "describe", "create_once"])
def test_a_failure_at_any_step_leaves_the_table_as_it_was(spark, folder, monkeypatch, step):
    path = folder("edits")
    edits = edit_frame(spark, 60)
    table.write_edits(edits, path)
    newer = edits.limit(20).withColumn("comment", F.lit("changed"))

    def fail(*args):
        raise OSError("storage")

    with monkeypatch.context() as broken:
        broken.setattr(log, step, fail)
        with pytest.raises(OSError, match="storage"):
            table.write_edits(newer, path)
    assert rows(stored(spark, path)) == rows(edits)
    table.write_edits(newer, path)
    expected = newer.unionByName(edits.join(newer.select("id"), "id", "left_anti").select(*EDIT_COLUMNS))
    assert rows(stored(spark, path)) == rows(expected)
    log.vacuum(spark, path, keep=1)
    assert rows(stored(spark, path)) == rows(expected)


def test_small_files_are_merged(spark, folder):
    path = folder("edits")
    edits = edit_frame(spark, 130).withColumn("ts", F.expr("timestamp'2024-02-01' + make_interval(0, 0, 0, 0, 0, crc32(id) % 1440, 0)"))
    most = 0
    for part in range(14):
        table.write_edits(edits.where(F.crc32("id") % 14 == part), path)
        log.compact(spark, path, fan_in=3)
        most = max(most, len(file_names(spark, path)))
    assert most <= 7  # two of each size class, and those of the newest batch
    assert rows(stored(spark, path)) == rows(edits)
    assert log.latest(spark, path).number > 14
    assert len(log.latest(spark, path).segments) <= log.SEGMENTS + 1
    assert log.compact(spark, path, fan_in=2, before="2024-02-01") == 0


def test_a_batch_of_a_stream_is_stored_once(spark, folder):
    path = folder("edits")
    edits = edit_frame(spark, 40)
    table.write_edits(edits, path, batch=("query", 3))
    table.write_edits(edits.withColumn("comment", F.lit("again")), path, batch=("query", 3))
    assert rows(stored(spark, path)) == rows(edits)
    table.write_edits(edits.withColumn("comment", F.lit("again")), path, batch=("query", 4))
    table.write_edits(edits, path, batch=("other", 0), on_conflict="keep")
    assert stored(spark, path).where("comment = 'again'").count() == 40
    assert {k: v[0] for k, v in log.latest(spark, path).applied.items()} == {"query": 4, "other": 0}


def test_first_deliveries(spark, folder):
    path = folder("edits")
    edits = edit_frame(spark, 60)
    new, again = table.first_deliveries(edits.limit(20), path, ("q", 0))
    assert not again and rows(new) == rows(edits.limit(20))
    new, again = table.first_deliveries(edits, path, ("q", 1))
    later = edits.join(edits.limit(20).select("id"), "id", "left_anti")
    assert not again and rows(new) == rows(later)
    # The same batch again, and one that holds nothing new.
    new, again = table.first_deliveries(edits, path, ("q", 1))
    assert again and rows(new) == rows(later)
    assert table.first_deliveries(edits, path, ("q", 2))[0].count() == 0
    assert table.first_deliveries(edits.limit(0), path, ("q", 3))[0].count() == 0
    assert rows(stored(spark, path)) == rows(edits)


def test_a_folder_without_log_is_taken_over(spark, folder):
    from editflow.operators.parse import calendar_fields

    path = folder("edits")
    edits = edit_frame(spark, 50)
    plain = calendar_fields(edits.limit(30)).select(*STORED.fieldNames())
    plain.write.partitionBy("year", "month", "day").parquet(path)
    assert rows(stored(spark, path)) == rows(edits.limit(30))
    table.write_edits(edits.withColumn("comment", F.lit("new")), path, on_conflict="keep")
    assert stored(spark, path).count() == 50 and stored(spark, path).where("comment = 'new'").count() == 20


def test_the_last_arrival_wins(spark, folder):
    """Among copies with offsets the greatest one, whatever their timestamps and texts."""
    path = folder("edits")
    edit = edit_frame(spark, 1).withColumns({"partition": F.lit(0), "offset": F.lit(1).cast("long")})
    copies = edit
    for offset, comment in ((7, "last"), (3, "zzz"), (5, "yyy")):
        copies = copies.union(edit.withColumns({"offset": F.lit(offset).cast("long"), "comment": F.lit(comment)}))
    table.write_edits(copies, path)
    assert [r.comment for r in stored(spark, path).collect()] == ["last"]


def test_empty_batch(spark, folder):
    path = folder("edits")
    table.write_edits(edit_frame(spark, 5), path)
    table.write_edits(edit_frame(spark, 5).limit(0), path)
    assert stored(spark, path).count() == 5


def test_rows_lie_in_key_order(spark, folder):
    path = folder("edits")
    table.write_edits(edit_frame(spark, 400), path)
    got = log.read_files(spark, path, sorted(file_names(spark, path))).select("_file", *STORED_KEY).collect()
    by_file = {}
    for r in got:
        by_file.setdefault(r._file, []).append(tuple(r)[1:])
    assert all(keys == sorted(keys) for keys in by_file.values())


def test_read_pushes_filters_and_columns(spark, folder):
    path = folder("edits")
    edits = edit_frame(spark, 300).withColumn("channel", F.lit("#de.wikipedia"))
    table.write_edits(edits, path)
    df = table.read_edits(spark, path, channel="#de.wikipedia", week=8, columns=["weekday"])
    expected = edits.where(F.weekofyear("ts") == 8).count()
    assert df.count() == expected > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(channel,#de.wikipedia)" in plan and "EqualTo(week,8)" in plan
    assert "month" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "comment" not in plan.split("ReadSchema")[1]
    assert table.read_edits(spark, path, week=8, year=2023).count() == 0


def test_months_of_a_week():
    assert table._months(1) == [1, 12] and table._months(53) == [1, 12]
    assert months_of_week(2025, 1) == [(2024, 12), (2025, 1)]
    assert months_of_week(2024, 53) == []
    for year in (2015, 2020, 2021, 2024):
        day = datetime.date(year, 1, 1)
        while day.year == year:
            iso = day.isocalendar()
            assert (day.year, day.month) in months_of_week(iso.year, iso.week)
            day += datetime.timedelta(days=1)


def test_weeks_across_new_year(spark, folder):
    """Week 1 of 2025 begins on 30 December 2024, week 52 of 2023 ends on 31 December 2023."""
    path = folder("edits")
    days = ["2023-12-31", "2024-01-01", "2024-12-29", "2024-12-30", "2024-12-31", "2025-01-01", "2025-01-05", "2025-01-06"]
    edits = edit_frame(spark, 8).withColumn("_n", F.row_number().over(Window.orderBy("id")))
    listed = F.array(*[F.lit(f"{d} 12:00:00") for d in days])
    edits = edits.withColumn("ts", F.get(listed, F.col("_n") - 1).cast("timestamp")).drop("_n")
    table.write_edits(edits, path)

    def dates(**wanted):
        return sorted(str(r.ts)[:10] for r in table.read_edits(spark, path, **wanted).collect())

    assert dates(week=1, year=2025) == days[3:7]
    assert dates(week=1, year=2024) == days[1:2]
    assert dates(week=52, year=2023) == days[:1]
    assert dates(week=52, year=2024) == days[2:3]
    assert dates(year=2024) == days[1:3]
    assert dates(week=1) == [days[1], *days[3:7]]
    assert dates(week=53, year=2024) == []


def test_bus_round_trip(spark):
    edits = edit_frame(spark, 200)
    frames = bus.encode_bus(edits)
    assert [f.dataType for f in frames.schema] == [f.dataType for f in BUS]
    good, bad = split_rejects(bus.decode_bus(frames))
    assert rows(good) == rows(edits) and bad.count() == 0
    broken = frames.withColumn("value", F.encode(F.lit("{oops"), "UTF-8"))
    good, bad = split_rejects(bus.decode_bus(broken))
    assert (good.count(), bad.count()) == (0, 200)


def test_missing_connectors_say_so(spark):
    with pytest.raises(AnalysisException, match="spark-avro"):
        bus.encode_bus(edit_frame(spark, 1), codec="avro")
    with pytest.raises(AnalysisException, match="kafka"):
        bus.read_bus(spark, {"subscribe": "edits"})


def test_json_lines_and_read_lines(spark, folder):
    edits = edit_frame(spark, 40)
    source, live = folder("source"), folder("live")
    lines.write_json_lines(edits, source)
    lines.write_json_lines(edits, live, view="live")
    keys = F.json_object_keys("raw")
    assert lines.read_lines(spark, source).select(F.size(keys)).distinct().collect() == [(15,)]
    row = lines.read_lines(spark, live).select(keys.alias("k"), "raw").first()
    assert len(row.k) == 16 and row.k[0] == "id"
    # A source line is what the JSON parser takes.
    from editflow.operators.parse import parse_json_edits

    back = parse_json_edits(lines.read_lines(spark, source)).where("_ok")
    without_id = [c for c in EDIT_COLUMNS if c != "id"]
    assert sorted(back.select(*without_id).collect()) == sorted(edits.select(*without_id).collect())


def test_models_are_saved_by_week_and_channel(spark, folder):
    path = folder("models")
    assert model_table.load_models(spark, path).count() == 0
    first = spark.createDataFrame([("#de.wikipedia", 2024, 51, 0, 1.5), ("#en.wikipedia", 2024, 51, 0, 9.0)], MODEL)
    model_table.save_models(first, path)
    again = spark.createDataFrame(
        [("#de.wikipedia", 2024, 51, 0, 2.5), ("#de.wikipedia", 2024, 52, 0, 3.5), ("#de.wikipedia", 2025, 51, 0, 4.5)],
        MODEL,
    )
    model_table.save_models(again, path)
    loaded = model_table.load_models(spark, path)
    assert loaded.schema == MODEL
    assert sorted(map(tuple, loaded.collect())) == [
        ("#de.wikipedia", 2024, 51, 0, 2.5),
        ("#de.wikipedia", 2024, 52, 0, 3.5),
        ("#de.wikipedia", 2025, 51, 0, 4.5),
        ("#en.wikipedia", 2024, 51, 0, 9.0),
    ]


def test_metrics_are_appended(spark, folder):
    path = folder("metrics")
    counted = spark.createDataFrame([("a", 3)], "name string, n long").withColumn("bucket", F.current_timestamp())
    model_table.write_metrics(counted, path)
    model_table.write_metrics(counted, path)
    assert [r.line for r in spark.read.parquet(path).collect()] == ["a:3|c", "a:3|c"]


def test_channel_catalog(spark):
    channels = [r.channel for r in catalog.channel_catalog(spark).collect()]
    assert len(channels) == len(set(channels)) == 53
    listed = catalog.channel_catalog(spark, [" de", "fa "], with_all=True).collect()
    assert [tuple(r) for r in listed] == [
        ("de", "#de.wikipedia"), ("fa", "#fa.wikipedia"), ("all", "#all.wikipedia"),
    ]


def test_checkpoint_root_is_the_session_setting(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
