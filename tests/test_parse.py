import datetime
import json

import pytest
from pyspark.sql import functions as F

from editflow.functions import text, validity
from editflow.operators import parse
from editflow.schema import EDIT_COLUMNS
from tests.data import URL, edit_frame, irc_line, wire_frame

RECORD = {
    "isRobot": False,
    "channel": "#en.wikipedia",
    "timestamp": "2020-12-31T23:30:02.250-01:00",
    "flags": "",
    "isUnpatrolled": False,
    "page": "Bridges over the Aare",
    "diffUrl": "https://wiki.example.org/change?to=5&from=3",
    "added": 57,
    "deleted": 0,
    "comment": "one more bridge",
    "isNew": False,
    "isMinor": False,
    "delta": 57,
    "user": "Kim",
    "namespace": "Main",
}


def lines(spark, *raw):
    at = datetime.datetime(2000, 1, 1)
    return spark.createDataFrame([(at, "foo", r) for r in raw], "ts timestamp, channel string, raw string")


def full(df):
    return parse.derive_added_deleted(parse.derive_namespace(parse.derive_flags(parse.parse_irc(df))))


def test_main_namespace_all_flags_added(spark):
    row = full(lines(spark, irc_line("Rivière: Gîte", "!MBN", "(+23)"))).first()
    assert (row.page, row.flags, row.diff_url) == ("Rivière: Gîte", "!MBN", URL)
    assert (row.user, row.comment) == ("Robin", "typo fixed")
    assert (row.delta, row.added, row.deleted, row.namespace) == (23, 23, 0, "Main")
    assert row.is_robot and row.is_unpatrolled and row.is_minor and row.is_new


def test_user_talk_namespace_no_flags_deleted(spark):
    row = full(lines(spark, irc_line("User talk:Rivière: Gîte", "", "(-23)"))).first()
    assert (row.page, row.flags, row.namespace) == ("User talk:Rivière: Gîte", "", "User talk")
    assert (row.delta, row.added, row.deleted) == (-23, 0, 23)
    assert not (row.is_robot or row.is_unpatrolled or row.is_minor or row.is_new)


def test_lines_without_a_match_give_no_row(spark):
    good = irc_line("Page", "M", "(+1)")
    bad = ["", "garbage", good + " ", " " + good, good[:-1], "a\nb\nc\nd\ne\nf", good.replace("e", "e\n")]
    assert parse.parse_irc(lines(spark, good, *bad)).count() == 1


def test_size_that_is_no_number_is_zero_and_overflow_is_dropped(spark):
    rows = parse.parse_irc(
        lines(
            spark,
            irc_line("a", "", "(log)"),
            irc_line("b", "", "whatever"),
            irc_line("c", "", "(+9223372036854775807)"),
            irc_line("d", "", "(+9223372036854775808)"),
            irc_line("e", " M B ", "(-7) trailing"),
        )
    ).collect()
    assert {r.page: r.delta for r in rows} == {"a": 0, "b": 0, "c": 2**63 - 1, "e": -7}
    assert {r.page: r.flags for r in rows}["e"] == "MB"


def test_typed_edits_drop_sizes_beyond_32_bits(spark):
    sizes = ["(+2147483647)", "(+2147483648)", "(-2147483647)", "(-2147483648)"]
    typed = parse.typed_edits(lines(spark, *[irc_line("p", "M", s) for s in sizes]))
    assert sorted(r.delta for r in typed.collect()) == [-2147483647, 2147483647]
    assert typed.columns == EDIT_COLUMNS


@pytest.mark.parametrize(
    ("page", "namespace"),
    [
        ("Talk:Page", "Talk"),
        ("User talk: Page", "Main"),
        ("Talk:", "Main"),
        (":Page", "Main"),
        ("A:B:C", "A"),
        ("Page", "Main"),
        ("A: B:C", "Main"),
    ],
)
def test_namespace(spark, page, namespace):
    df = spark.createDataFrame([(page,)], "page string")
    assert parse.derive_namespace(df).first().namespace == namespace


@pytest.mark.parametrize(
    ("flags", "expected"),
    [("", [""]), (",", []), (",,", []), ("a,b,,", ["a", "b"]), (",a", ["", "a"]), ("MB", ["MB"]), ("a,,b", ["a", "", "b"])],
)
def test_flags_to_list(spark, flags, expected):
    df = spark.createDataFrame([(flags,)], "flags string")
    split = parse.split_flags(df)
    assert split.first().flags == expected
    assert parse.join_flags(split).first().flags == ",".join(expected)


def changed(**fields):
    record = {**RECORD, **fields}
    return json.dumps({k: v for k, v in record.items() if v is not ...})


REJECTS = [
    "not json",
    "",
    "[1]",
    '{"channel": "#en.wikipedia"}',
    changed(user=...),
    changed(user=None),
    changed(isRobot="false"),
    changed(isRobot=0),
    changed(channel=5),
    changed(added="57"),
    changed(added=1.0),
    changed(added=1.5),
    changed(added=True),
    changed(delta=2**31),
    changed(delta=-(2**31) - 1),
    changed(delta=10**30),
    changed(timestamp="yesterday"),
    changed(timestamp="T10"),
    changed(timestamp="2015-12-23 17:00:00"),
    changed(timestamp="2015-13-23T17:00:00Z"),
    changed(timestamp=""),
    changed(diffUrl="nourl"),
    changed(diffUrl="gopher2://a.b"),
    changed(diffUrl="http://a.b:port/c"),
    changed(diffUrl=""),
    changed().replace('"user"', '"user": "x", "user"'),
]
ACCEPTED = [
    changed(),
    changed(extra={"a": [1]}),
    changed(page="", comment="", user=""),
    changed(delta=2**31 - 1, added=2**31 - 1),
    changed(timestamp="2015-12-23T17:00Z"),
    changed(timestamp="2015-12-23"),
    changed(diffUrl="HTTP://a.b:8080/c?d=e:f"),
    changed(page="tab\t \"quoted\" ğ"),
]


def test_json_lines_are_strict(spark):
    rows = [(i, r) for i, r in enumerate(REJECTS + ACCEPTED)]
    parsed = parse.parse_json_edits(spark.createDataFrame(rows, "i int, raw string"))
    ok = {r.i: r._ok for r in parsed.collect()}
    assert [i for i in range(len(REJECTS)) if ok[i]] == []
    assert [i for i in range(len(REJECTS), len(rows)) if not ok[i]] == []
    good, bad = parse.split_rejects(parsed)
    assert (good.count(), bad.count()) == (len(ACCEPTED), len(REJECTS))


def test_json_values(spark):
    row = parse.parse_json_edits(spark.createDataFrame([(changed(),)], "raw string")).first()
    assert row.ts == datetime.datetime(2021, 1, 1, 0, 30, 2, 250000)
    assert (row.flags, row.added, row.user, row.is_robot) == ([""], 57, "Kim", False)
    assert row.page == RECORD["page"]


def test_every_field_of_a_wire_record_is_kept(spark):
    wire, records = wire_frame(spark, 200)
    rows = {r.id: r for r in parse.normalize_edits(wire).collect()}
    for record in records:
        row = rows[record["id"]]
        assert row._ok
        assert row.ts.strftime("%Y-%m-%dT%H:%M:%S.000Z") == record["timestamp"]
        assert row.flags == [record["flags"]]
        for key, column in [
            ("isRobot", "is_robot"), ("channel", "channel"), ("isUnpatrolled", "is_unpatrolled"),
            ("page", "page"), ("diffUrl", "diff_url"), ("added", "added"), ("deleted", "deleted"),
            ("comment", "comment"), ("isNew", "is_new"), ("isMinor", "is_minor"), ("delta", "delta"),
            ("user", "user"), ("namespace", "namespace"),
        ]:
            assert row[column] == record[key]


def test_wire_record_with_a_fault_is_not_ok(spark):
    wire, _ = wire_frame(spark, 1)
    for column, value in [("id", "no-uuid"), ("diffUrl", "x"), ("timestamp", "T10"), ("user", None)]:
        changed_row = wire.withColumn(column, F.lit(value).cast("string"))
        assert parse.normalize_edits(changed_row).first()._ok is False


def test_content_ids_are_stable_uuids(spark):
    raw = [irc_line(f"p{i}", "M", "(+1)") for i in range(20)]
    first = [r.id for r in parse.assign_id(parse.parse_irc(lines(spark, *raw))).collect()]
    again = [r.id for r in parse.assign_id(parse.parse_irc(lines(spark, *raw))).collect()]
    assert first == again and len(set(first)) == 20
    df = spark.createDataFrame([(i,) for i in first], "id string")
    assert df.where(validity.is_uuid(F.col("id"))).count() == 20
    random_ids = parse.assign_id(parse.parse_irc(lines(spark, *raw)), mode="random")
    assert random_ids.where(validity.is_uuid(F.col("id"))).select("id").distinct().count() == 20


def test_calendar_fields(spark):
    df = spark.createDataFrame([("2021-01-03T23:59:58.500+02:00",)], "_written string")
    df = df.withColumn("ts", validity.to_instant(F.col("_written")))
    utc = parse.calendar_fields(df).first()
    assert (utc.year, utc.month, utc.day, utc.week, utc.weekday) == (2021, 1, 3, 53, 7)
    assert (utc.hour, utc.minute, utc.time, utc.day_minute) == (21, 59, 21 * 3600 + 59 * 60 + 58, 21 * 60 + 59)
    offset = parse.calendar_fields(df, wall="offset").first()
    assert (offset.hour, offset.time) == (23, 23 * 3600 + 59 * 60 + 58)


def test_channel_names(spark):
    df = spark.createDataFrame([(" de ",)], "code string").select(text.channel_name(F.col("code")).alias("c"))
    assert df.first().c == "#de.wikipedia"
    assert df.select(text.channel_code(F.col("c"))).first()[0] == "de"


def test_stored_row_gives_back_the_edit(spark):
    edits = edit_frame(spark, 50)
    back = parse.edit_from_row(parse.calendar_fields(edits))
    assert sorted(back.collect()) == sorted(edits.collect())


def test_feed_and_metric_names(spark):
    row = parse.ui_feed(edit_frame(spark, 1)).first()
    assert list(row.asDict()) == ["user", "text", "timestamp", "diff_url"]
    names = parse.metric_name(spark.createDataFrame([("#de.wikipedia",), (None,)], "channel string"))
    assert [tuple(r)[1:] for r in names.collect()] == [
        ("#de.wikipedia", "#de.wikipedia-anomaly", "de.wikipedia"),
        ("all-messages", None, "all-messages"),
    ]


def test_every_line_is_a_row_or_a_reject_with_its_reason(spark):
    sizes = ["(+18)", "(+3000000000)", "(+99999999999999999999)", "(log)"]
    raw = lines(spark, "garbage", *[irc_line("p", "M", s) for s in sizes])
    rejected = parse.rejected_lines(raw)
    assert sorted(r.reason for r in rejected.collect()) == [
        "delta beyond 32 bits", "delta beyond 64 bits", "no change line"
    ]
    assert parse.typed_edits(raw).count() + rejected.count() == raw.count()
