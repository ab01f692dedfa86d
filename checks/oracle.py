"""The same results in SQL of the second engine."""

from checks import fixtures

# Fixed value: the layout of a change line, in the second engine's regular expressions.
_LINE = (
    r"\A\x0314\[\[\x0307(.+?)\x0314\]\]\x034 (.*?)\x0310.*\x0302(http.+?)"
    r"\x03.+\x0303(.+?)\x03.+\x03 (\(([+-]\d+)\).*|.+) \x0310(.+)\x03\z"
)

# Common table expressions by name, and the ones that each needs.
_PARTS: dict[str, tuple[list[str], str]] = {
    "edits_fx": ([], fixtures.EDITS.format(events="events")),
    "irc_fx": (["edits_fx"], fixtures.IRC.format(edits_fx="edits_fx")),
    "json_fx": (["edits_fx"], fixtures.JSON.format(edits_fx="edits_fx")),
    "metrics_fx": ([], fixtures.METRICS.format(events="events")),
    "subscriptions_fx": ([], fixtures.SUBSCRIPTIONS),
    "parsed": (
        ["irc_fx"],
        f"""
select event_id, ts, channel, g.page, regexp_replace(g.flags, '\\s+', '', 'g') as flags,
  g.diff_url, g.usr as "user", coalesce(try_cast(nullif(g.delta, '') as bigint), 0) as delta, g.remark as comment
from (select *, regexp_extract(raw, '{_LINE}', ['page', 'flags', 'diff_url', 'usr', 'size', 'delta', 'remark']) as g
      from irc_fx where regexp_matches(raw, '{_LINE}'))
""",
    ),
    "typed": (
        ["parsed"],
        """
select event_id, ts, channel, page, flags, diff_url, "user", comment, cast(delta as int) as delta,
  contains(flags, 'B') as is_robot, contains(flags, 'M') as is_minor,
  contains(flags, 'N') as is_new, contains(flags, '!') as is_unpatrolled,
  coalesce(nullif(regexp_extract(page, '\\A([^:]+):\\S.*\\z', 1), ''), 'Main') as namespace,
  cast(greatest(delta, 0) as int) as added, cast(greatest(-delta, 0) as int) as deleted,
  concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) as id
from (select *, sha256(concat_ws(chr(3) || '|', cast(epoch_us(ts) as varchar), channel, page, flags,
        diff_url, "user", cast(delta as varchar), comment)) as h from parsed)
""",
    ),
    "stored": (
        ["typed"],
        """
select *, cast(year(ts) as int) as year, cast(month(ts) as int) as month, cast(weekofyear(ts) as int) as week,
  cast(day(ts) as int) as day, cast(hour(ts) as int) as hour, cast(minute(ts) as int) as minute,
  cast(isodow(ts) as int) as weekday,
  cast(hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts)) as int) as time,
  cast(hour(ts) * 60 + minute(ts) as int) as day_minute
from typed
""",
    ),
    "json_fields": (
        ["json_fx"],
        """
select event_id, raw, case when json_valid(raw) then cast(raw as json) end as j from json_fx
""",
    ),
    "json_typed": (
        ["json_fields"],
        """
select event_id, coalesce(
    json_type(j, '$.isRobot') = 'BOOLEAN' and json_type(j, '$.channel') = 'VARCHAR'
    and json_type(j, '$.timestamp') = 'VARCHAR' and json_type(j, '$.flags') = 'VARCHAR'
    and json_type(j, '$.isUnpatrolled') = 'BOOLEAN' and json_type(j, '$.page') = 'VARCHAR'
    and json_type(j, '$.diffUrl') = 'VARCHAR' and json_type(j, '$.added') in ('UBIGINT', 'BIGINT')
    and json_type(j, '$.deleted') in ('UBIGINT', 'BIGINT') and json_type(j, '$.comment') = 'VARCHAR'
    and json_type(j, '$.isNew') = 'BOOLEAN' and json_type(j, '$.isMinor') = 'BOOLEAN'
    and json_type(j, '$.delta') in ('UBIGINT', 'BIGINT') and json_type(j, '$.user') = 'VARCHAR'
    and json_type(j, '$.namespace') = 'VARCHAR'
    and try_cast(json_extract_string(j, '$.timestamp') as timestamptz) is not null
    and regexp_matches(json_extract_string(j, '$.diffUrl'), '^(https?|ftp|file|jar|mailto):'), false) as ok,
  json_extract_string(j, '$.channel') as channel,
  try_cast(json_extract_string(j, '$.timestamp') as timestamptz) as ts,
  try_cast(left(json_extract_string(j, '$.timestamp'), 23) as timestamp) as wall,
  json_extract_string(j, '$.flags') as flags_text,
  json_extract_string(j, '$.page') as page, json_extract_string(j, '$.diffUrl') as diff_url,
  json_extract_string(j, '$.comment') as comment, json_extract_string(j, '$.user') as "user",
  json_extract_string(j, '$.namespace') as namespace,
  try_cast(json_extract_string(j, '$.added') as int) as added,
  try_cast(json_extract_string(j, '$.deleted') as int) as deleted,
  try_cast(json_extract_string(j, '$.delta') as int) as delta,
  json_extract_string(j, '$.isRobot') = 'true' as is_robot, json_extract_string(j, '$.isMinor') = 'true' as is_minor,
  json_extract_string(j, '$.isNew') = 'true' as is_new,
  json_extract_string(j, '$.isUnpatrolled') = 'true' as is_unpatrolled
from json_fields
""",
    ),
    "json_flags": (
        ["json_typed"],
        """
select *, case when flags_text = '' then [''] when rtrim(flags_text, ',') = '' then cast([] as varchar[])
  else string_split(rtrim(flags_text, ','), ',') end as flags
from json_typed
""",
    ),
    "hourly": (
        ["typed"],
        """
select date_trunc('hour', ts) as bucket, channel, count(*) as n from typed group by all
""",
    ),
    "filled": (
        ["hourly"],
        """
select s.bucket, s.channel, coalesce(h.n, 0) as n
from (select channel, unnest(generate_series(min(bucket), (select max(bucket) from hourly), interval 1 hour)) as bucket
      from hourly group by channel) s
left join hourly h on h.channel = s.channel and h.bucket = s.bucket
""",
    ),
    # Plain models for the lookups: least, mean and greatest hourly count of a channel.
    "profile": (
        ["hourly"],
        """
select channel, 2024 as year, 1 as week, unnest([0, 1, 2]) as cluster,
  unnest([cast(min(n) as double), cast(sum(n) as double) / count(*), cast(max(n) as double)]) as centre
from hourly group by channel
""",
    ),
    "marked": (
        ["typed"],
        """
select channel as name, time_bucket(interval '30 minutes', ts) as bucket, is_robot from typed
union all select 'all-messages', time_bucket(interval '30 minutes', ts), is_robot from typed
""",
    ),
    "nearest": (
        ["hourly", "profile"],
        """
select bucket, channel, n, cluster, centre, abs(n - centre) as distance
from hourly join profile using (channel)
qualify row_number() over (partition by bucket, channel order by abs(n - centre), cluster) = 1
""",
    ),
}


def _kmeans(k: int, steps: int) -> dict[str, tuple[list[str], str]]:
    """Lloyd's iterations of the hour-of-week counts of ISO week 1, one step per expression."""
    parts = {
        "cells": (
            ["stored"],
            "select channel, n, count(*) as w from (select channel, weekday, hour, count(*) as n "
            "from stored where week = 1 group by all) group by all",
        ),
        "spaced": (
            ["cells"],
            "select channel, n, row_number() over (partition by channel order by n) - 1 as r, "
            "count(*) over (partition by channel) as nd from cells",
        ),
        "step0": (
            ["spaced"],
            "select channel, cast(row_number() over (partition by channel order by n) - 1 as int) as cluster, "
            "cast(n as double) as centre from spaced where r in "
            f"(select floor(j * (nd - 1) / {k - 1}) from range(0, {k}) t(j))",
        ),
    }
    for i in range(1, steps + 1):
        last = f"step{i - 1}"
        parts[f"near{i}"] = (
            ["cells", last],
            f"select c.channel, m.cluster, c.n, c.w from cells c join {last} m using (channel) "
            "qualify row_number() over (partition by c.channel, c.n order by abs(c.n - m.centre), m.cluster) = 1",
        )
        parts[f"step{i}"] = (
            [last, f"near{i}"],
            f"select m.channel, m.cluster, coalesce(a.centre, m.centre) as centre from {last} m left join "
            f"(select channel, cluster, cast(sum(n * w) as double) / cast(sum(w) as double) as centre "
            f"from near{i} group by all) a on a.channel = m.channel and a.cluster = m.cluster",
        )
    parts["stepwise"] = ([f"step{steps}"], f"select channel, 2024 as year, 1 as week, cluster, centre from step{steps}")
    return parts


def _best(name: str, k: int, grain: str) -> dict[str, tuple[list[str], str]]:
    """The best k clusters of the counts of ISO week 1: all beginnings of the last cluster are tried."""
    return {
        f"points_{name}": (
            ["stored"],
            f"""
select channel, n, row_number() over (partition by channel order by n) as i, count(*) over (partition by channel) as nd,
  cast(sum(w) over below as bigint) as mass, cast(sum(w * n) over below as bigint) as first,
  cast(sum(w * n * n) over below as bigint) as second
from (select channel, n, count(*) as w from (select channel, {grain}, count(*) as n from stored
        where week = 1 and isoyear(ts) = (select max(isoyear(ts)) from stored where week = 1) group by all) group by all)
window below as (partition by channel order by n)
""",
        ),
        f"sums_{name}": (
            [f"points_{name}"],
            f"select channel, i, mass, first, second from points_{name} "
            f"union all select distinct channel, 0, 0, 0, 0 from points_{name}",
        ),
        f"splits_{name}": (
            [f"sums_{name}"],
            f"""
with recursive split(channel, runs, i, cost, l) as (
  select channel, 1, i, cast(second as double) - cast(first as double) * cast(first as double) / cast(mass as double), 0
  from points_{name}
  union all
  select channel, runs, i, best.c, best.l from (
    select e.channel, d.runs + 1 as runs, e.i, min({{'c': d.cost + (cast(e.second - b.second as double)
        - cast(e.first - b.first as double) * cast(e.first - b.first as double) / cast(e.mass - b.mass as double)), 'l': d.i}}) as best
    from split d join sums_{name} b on b.channel = d.channel and b.i = d.i
    join points_{name} e on e.channel = d.channel and e.i > d.i
    where d.runs < least({k}, e.nd) group by e.channel, d.runs, e.i)
) select * from split
""",
        ),
        f"{name}": (
            [f"splits_{name}"],
            f"""
with recursive back(channel, runs, i, l) as (
  select s.channel, s.runs, s.i, s.l from splits_{name} s join points_{name} p using (channel, i)
  where s.runs = least({k}, p.nd) and p.i = p.nd
  union all
  select s.channel, s.runs, s.i, s.l from back b join splits_{name} s
    on s.channel = b.channel and s.runs = b.runs - 1 and s.i = b.l
)
select channel, 2024 as year, 1 as week, cast(runs - 1 as int) as cluster,
  cast(e.first - b.first as double) / cast(e.mass - b.mass as double) as centre
from back r join sums_{name} e using (channel, i) join sums_{name} b on b.channel = r.channel and b.i = r.l
""",
        ),
    }


FEW, STEPS = 4, 20
_PARTS.update(_kmeans(FEW, STEPS))
_PARTS.update(_best("few", FEW, "weekday, hour"))
_PARTS.update(_best("hourly_models", 55, "weekday, hour"))
_PARTS.update(_best("minute_models", 55, "weekday, day_minute"))
for _scored, _models in (("scored", "hourly_models"), ("scored_few", "few")):
    _PARTS[_scored] = (
        ["filled", _models],
        f"""
select bucket, channel, n, cluster, centre, abs(n - centre) as distance,
  centre * cast(0.05 as double) < abs(n - centre) as is_anomaly
from filled join {_models} using (channel)
where bucket >= (select date_trunc('week', min(ts)) + interval 7 day from typed where weekofyear(ts) = 1)
qualify row_number() over (partition by bucket, channel order by abs(n - centre), cluster) = 1
""",
    )


def _with(needed: list[str], query: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for part in _PARTS[name][0]:
                visit(part)
            order.append(name)

    for name in needed:
        visit(name)
    parts = ",\n".join(f"{name} as materialized ({_PARTS[name][1].strip()})" for name in order)
    return f"with {parts}\n{query.strip()}" if parts else query.strip()


_EDIT = """id, is_robot, channel, {ts} as ts, flags, is_unpatrolled, page, diff_url, added, deleted,
  comment, is_new, is_minor, delta, "user", namespace"""
_EDIT_MICROS = _EDIT.format(ts="epoch_us(ts)")
_EDIT_MILLIS = _EDIT.format(ts="epoch_us(ts) // 1000 * 1000")
_CALENDAR = "year, month, week, day, hour, minute, weekday, time, day_minute"
_JSON_EDIT = """is_robot, channel, epoch_us(ts) as ts, array_to_string(flags, '|') as flags,
  cast(len(flags) as int) as flag_count, is_unpatrolled, page, diff_url, added, deleted, comment, is_new, is_minor,
  delta, "user", namespace"""
# The watermark of the streams stays an hour behind the newest edit.
_CLOSED = "bucket + interval 2 hour <= (select max(ts) from typed)"


def _bucket(interval: str, column: str = "ts") -> str:
    return f"time_bucket(interval '{interval}', {column})"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # Sources and sinks
    q["read_lines"] = _with(["irc_fx"], "select raw from irc_fx")
    q["stream_lines"] = q["read_lines"]
    q["read_bus"] = _with(["typed"], f"select {_EDIT_MILLIS} from typed")
    q["read_edits"] = _with(
        ["stored"],
        "select id, weekday, day_minute from stored where channel = '#click.wikipedia' and week = 2",
    )
    q["get_by_id"] = _with(
        ["typed"], f"select {_EDIT_MICROS} from typed where id = (select min(id) from typed)"
    )
    q["find_edit"] = q["get_by_id"]
    q["compact_edits"] = _with(["stored"], f"select {_EDIT_MICROS}, {_CALENDAR} from stored")
    q["stored_total"] = _with(["stored"], "select count(*) as n from stored")
    q["channel_catalog"] = """
select distinct event_type as code, '#' || event_type || '.wikipedia' as channel from events
union all select 'all', '#all.wikipedia'
"""
    q["write_edits"] = _with(
        ["stored"],
        f"""
select id, is_robot, channel, epoch_us(ts) as ts, flags, is_unpatrolled, page, diff_url, added, deleted,
  case when is_robot then comment || ' (again)' else comment end as comment, is_new, is_minor, delta, "user",
  namespace, {_CALENDAR}
from stored
""",
    )
    bus_value = """
'{"id":"' || id || '","isRobot":' || is_robot || ',"channel":"' || channel || '","timestamp":"'
  || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z","flags":"' || flags || '","isUnpatrolled":' || is_unpatrolled
  || ',"page":"' || page || '","diffUrl":"' || diff_url || '","added":' || added || ',"deleted":' || deleted
  || ',"comment":"' || comment || '","isNew":' || is_new || ',"isMinor":' || is_minor || ',"delta":' || delta
  || ',"user":"' || "user" || '","namespace":"' || namespace || '"}'
"""
    q["encode_bus"] = _with(["typed"], f"select channel as key, {bus_value} as value from typed")
    q["write_bus"] = q["encode_bus"]
    q["decode_bus"] = q["read_bus"]
    q["write_json_lines"] = _with(
        ["typed"],
        """
select id, epoch_us(ts) // 1000 as live_millis, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') as source_timestamp, channel, page,
  flags, '["' || flags || '"]' as live_flags, diff_url, "user", cast(delta as varchar) as delta,
  cast(added as varchar) as added, cast(deleted as varchar) as deleted, comment, cast(is_robot as varchar) as is_robot,
  namespace, 15 as source_keys, 16 as live_keys
from typed
""",
    )
    models = "select channel, year, week, cluster, round(centre, 6) as centre from {}"
    q["fit_all_models"] = _with(["minute_models"], models.format("minute_models"))
    q["fit_channel_model"] = q["fit_all_models"] + " where channel = '#click.wikipedia'"
    q["fit_few_clusters"] = _with(["few"], models.format("few"))
    q["fit_models_stepwise"] = _with(["stepwise"], models.format("stepwise"))
    q["save_models"] = q["fit_few_clusters"]
    q["load_models"] = q["fit_few_clusters"]
    rollup = f"""
select {_bucket('10 seconds')} as bucket, 'all-messages' as name, count(*) as n from typed group by 1
union all
select {_bucket('10 seconds')} as bucket, channel as name, count(*) as n from typed group by 1, 2
"""
    q["count_rollup"] = _with(["typed"], f"select epoch_us(bucket) as bucket, name, n from ({rollup})")
    q["write_metrics"] = _with(
        ["typed"],
        "select epoch_us(bucket) as bucket, name, n as value, name || ':' || n || '|c' as line "
        f"from ({rollup})",
    )
    q["fan_out"] = _with(
        ["json_typed"],
        """
select 'sampled' as sink, cast(ceil(count(*) / 50.0) as bigint) as seen from json_typed
union all select 'counted', count(*) from json_typed
union all select 'published', count(*) from json_typed where ok
""",
    )

    # Projections
    q["parse_irc"] = _with(
        ["parsed"],
        'select event_id, epoch_us(ts) as ts, channel, page, flags, diff_url, "user", delta, comment from parsed',
    )
    q["derive_flags"] = _with(
        ["typed"], "select event_id, is_robot, is_minor, is_new, is_unpatrolled from typed"
    )
    q["derive_namespace"] = _with(["typed"], "select event_id, page, namespace from typed")
    q["derive_added_deleted"] = _with(
        ["parsed"],
        "select event_id, delta, greatest(delta, 0) as added, greatest(-delta, 0) as deleted from parsed",
    )
    q["parse_json_edits"] = _with(
        ["json_flags"],
        f"select event_id, {_JSON_EDIT} from json_flags where ok",
    )
    q["split_rejects"] = _with(
        ["json_typed"],
        "select event_id, case when ok then 'good' else 'bad' end as side from json_typed",
    )
    q["assign_id"] = _with(["typed"], "select event_id, id from typed")
    q["split_flags"] = _with(
        ["json_flags"],
        "select event_id, cast(len(flags) as int) as flag_count, array_to_string(flags, '|') as flags from json_flags where ok",
    )
    q["join_flags"] = _with(
        ["json_flags"],
        "select event_id, array_to_string(flags, ',') as flags from json_flags where ok",
    )
    q["normalize_edits"] = _with(["typed"], f"select {_EDIT_MILLIS}, true as ok from typed")
    wall_fields = """
cast(year(wall) as int) as year, cast(month(wall) as int) as month, cast(weekofyear(wall) as int) as week,
  cast(day(wall) as int) as day, cast(hour(wall) as int) as hour, cast(minute(wall) as int) as minute,
  cast(isodow(wall) as int) as weekday,
  cast(hour(wall) * 3600 + minute(wall) * 60 + floor(second(wall)) as int) as time,
  cast(hour(wall) * 60 + minute(wall) as int) as day_minute
"""
    q["calendar_fields"] = _with(
        ["stored", "json_typed"],
        f"""
select event_id, 'utc' as clock, {_CALENDAR} from stored
union all select event_id, 'offset' as clock, {wall_fields} from json_typed where ok
""",
    )
    q["edit_from_row"] = _with(["typed"], f"select {_EDIT_MICROS} from typed")
    q["channel_name"] = """
select event_id, '#' || event_type || '.wikipedia' as channel, event_type as code from events
"""
    q["ui_feed"] = _with(
        ["typed"], 'select "user", page as text, epoch_us(ts) as timestamp, diff_url from typed'
    )
    q["metric_name"] = _with(
        ["typed"],
        """
select channel as counter_name, channel || '-anomaly' as anomaly_name, substring(channel, 2) as dashboard_name
from typed group by channel
union all select 'all-messages', null, 'all-messages'
""",
    )

    # Filters
    q["filter_channel"] = _with(
        ["typed"], f"select {_EDIT_MICROS} from typed where channel = '#view.wikipedia'"
    )
    q["filter_week"] = _with(["stored"], "select id, year, week from stored where week = 3")
    q["sample_metrics"] = _with(
        ["metrics_fx"],
        "select event_id, name, cast(0.3 as double) as rate from metrics_fx "
        "where cast('0x' || md5(event_id || ':42')[1:8] as bigint) < 0.3 * 4294967296",
    )
    q["every_nth"] = _with(
        ["typed"],
        "select id, position from (select id, row_number() over (order by ts, id) - 1 as position from typed) "
        "where position % 50 = 0",
    )
    q["recent_window"] = _with(
        ["typed"],
        "select id, epoch_us(ts) as ts from typed where ts >= (select max(ts) from typed) - interval 15 minutes",
    )

    # Joins
    q["attach_model"] = _with(
        ["hourly", "profile"],
        """
select epoch_us(bucket) as bucket, h.channel, n, m.week as model_week, least_centre, greatest_centre
from hourly h join (select channel, week, round(min(centre), 6) as least_centre,
  round(max(centre), 6) as greatest_centre from profile
  where channel <> '#error.wikipedia' group by all) m using (channel)
""",
    )
    q["attach_model_before"] = _with(
        ["hourly"],
        """
select epoch_us(h.bucket) as bucket, h.channel, n, model_year, model_week, least_centre, greatest_centre
from hourly h asof join (
  select channel, isoyear(monday) as model_year, weekofyear(monday) as model_week, least_centre, greatest_centre,
    monday + interval 7 day as since
  from (select channel, date_trunc('week', bucket) as monday, cast(min(n) as double) as least_centre,
          cast(max(n) as double) as greatest_centre from hourly group by all)
  where channel <> '#error.wikipedia' or weekofyear(monday) % 2 = 0
) m on h.channel = m.channel and h.bucket >= m.since
""",
    )
    q["nearest_centroid"] = _with(
        ["nearest"],
        "select epoch_us(bucket) as bucket, channel, n, cluster, round(centre, 6) as centre, "
        "round(distance, 6) as distance from nearest",
    )
    q["score_distance"] = _with(
        ["nearest"],
        "select epoch_us(bucket) as bucket, channel, round(distance, 6) as distance from nearest",
    )
    q["route_edits"] = _with(
        ["typed", "subscriptions_fx"],
        "select s.subscriber, e.id, e.channel from typed e join subscriptions_fx s "
        "on s.channel = '#all.wikipedia' or s.channel = e.channel",
    )

    # Counts
    q["count_all"] = _with(
        ["typed"],
        f"select epoch_us({_bucket('10 seconds')}) as bucket, 'all-messages' as name, count(*) as n "
        "from typed group by 1",
    )
    q["count_by_channel"] = _with(
        ["typed"],
        f"select epoch_us({_bucket('10 seconds')}) as bucket, channel, count(*) as n from typed group by 1, 2",
    )
    q["count_matching"] = _with(
        ["typed"],
        f"""
select epoch_us(s.bucket) as bucket, 'robot-edits' as name, coalesce(n, 0) + 2 as n
from (select unnest(generate_series({_bucket('60 seconds', 'min(ts)')}, {_bucket('60 seconds', 'max(ts)')},
        interval 1 minute)) as bucket from typed) s
left join (select {_bucket('60 seconds')} as bucket, count(*) filter (where is_robot) as n from typed group by 1) c
  on c.bucket = s.bucket
""",
    )
    q["count_items"] = _with(
        ["json_typed"],
        "select count(*) as items, count(*) filter (where ok) as accepted, "
        "count(*) filter (where not ok) as rejected from json_typed",
    )
    q["inserted_total"] = _with(
        ["typed"],
        f"""
select epoch_us(bucket) as bucket, n, cast(sum(n) over (order by bucket) as bigint) as inserted
from (select {_bucket('10 seconds')} as bucket, count(*) as n from typed group by 1)
""",
    )
    q["weekly_minute_counts"] = _with(
        ["stored"],
        "select weekday, day_minute, count(*) as n from stored "
        "where channel = '#click.wikipedia' and week = 2 group by all",
    )
    q["count_vectors"] = _with(
        ["stored"],
        "select cast(count(*) as double) as feature from stored "
        "where channel = '#click.wikipedia' and week = 2 group by weekday, day_minute",
    )
    q["anomaly_counts"] = _with(
        ["nearest"],
        "select epoch_us(date_trunc('day', bucket)) as bucket, channel || '-anomaly' as name, "
        "count(*) filter (where centre * cast(0.05 as double) < distance) as n from nearest group by 1, 2",
    )
    q["clustering_score"] = _with(
        ["nearest"], "select channel, round(avg(distance), 6) as score from nearest group by 1"
    )

    # Metrics
    q["metric_counter"] = _with(
        ["metrics_fx"],
        f"select epoch_us({_bucket('1 hour')}) as bucket, name, round(sum(value / rate), 6) as value "
        "from metrics_fx where kind = 'c' group by 1, 2",
    )
    q["metric_gauge"] = _with(
        ["metrics_fx"],
        f"""
select epoch_us(bucket) as bucket, name, value from (
  select bucket, name, ts, event_id, sum(amount) over (partition by name, reset order by ts, event_id) as value
  from (select {_bucket('1 hour')} as bucket, name, ts, event_id, cast(setting as double) as amount,
          sum(case when setting[1:1] in ('+', '-') then 0 else 1 end)
            over (partition by name order by ts, event_id) as reset
        from metrics_fx where kind = 'g'))
qualify row_number() over (partition by bucket, name order by ts desc, event_id desc) = 1
""",
    )
    q["metric_set"] = _with(
        ["metrics_fx"],
        f"select epoch_us({_bucket('1 hour')}) as bucket, name, count(distinct value) as value "
        "from metrics_fx where kind = 's' group by 1, 2",
    )
    q["metric_timing"] = _with(
        ["metrics_fx"],
        f"""
select epoch_us({_bucket('1 day')}) as bucket, name, count(*) as samples,
  cast(min(value) as bigint) as least, cast(max(value) as bigint) as greatest,
  round(cast(sum(value) as double) / count(*), 6) as mean,
  round(quantile_cont(cast(value as double), 0.5), 6) as p50, round(quantile_cont(cast(value as double), 0.9), 6) as p90
from metrics_fx where kind = 'ms' group by 1, 2
""",
    )
    q["metric_timing_fractions"] = _with(
        ["metrics_fx"],
        f"""
select epoch_us({_bucket('1 day')}) as bucket, name, count(*) as samples, round(min(millis), 6) as least,
  round(max(millis), 6) as greatest, round(avg(millis), 6) as mean, round(quantile_cont(millis, 0.5), 6) as p50,
  round(quantile_cont(millis, 0.9), 6) as p90
from metrics_fx group by 1, 2
""",
    )
    q["metric_sketches"] = _with(
        ["metrics_fx"],
        """
select epoch_us(time_bucket(interval '7 days', ts, timestamp '1970-01-01')) as bucket, name, kind, count(*) as samples,
  case when kind = 'ms' then round(min(millis), 6) end as least,
  case when kind = 'ms' then round(max(millis), 6) end as greatest,
  case when kind = 'ms' then round(avg(millis), 6) end as mean, true as near
from metrics_fx where kind in ('ms', 's') group by 1, 2, 3
""",
    )
    q["metric_lines"] = _with(
        ["metrics_fx"],
        "select event_id, name || ':' || value || '|' || kind || case when rate < 1 then '|@' || rate else '' end "
        "as line from metrics_fx",
    )

    # Series
    q["zero_fill"] = _with(["filled"], "select epoch_us(bucket) as bucket, channel, n from filled")
    q["moving_average"] = _with(
        ["hourly"],
        "select epoch_us(bucket) as bucket, channel, n, round(avg(n) over (partition by channel order by bucket "
        "rows between 9 preceding and current row), 6) as average from hourly",
    )
    q["running_count"] = _with(
        ["typed"],
        "select id, channel, row_number() over (partition by channel order by ts, id) as message_number from typed",
    )
    q["latest_n"] = _with(
        ["typed"],
        "select id, channel, recency from (select id, channel, cast(row_number() over "
        "(partition by channel order by ts desc, id desc) as int) as recency from typed) where recency <= 8",
    )
    q["clustering_order"] = _with(["stored"], 'select id, year, month, day, time, "user" from stored')

    # Anomalies
    for name, part in (("detect_anomalies", "scored"), ("detect_anomalies_few", "scored_few")):
        q[name] = _with(
            [part],
            "select epoch_us(bucket) as bucket, channel, n, cluster, round(centre, 6) as centre, "
            f"round(distance, 6) as distance, is_anomaly from {part}",
        )

    # Streaming
    q["stream_counts"] = _with(
        ["typed", "hourly"],
        f"select epoch_us(bucket) as bucket, channel, n from hourly where {_CLOSED}",
    )
    q["on_flush"] = q["stream_counts"]
    q["stream_tallies"] = _with(
        ["marked"],
        """
select epoch_us(s.bucket) as bucket, s.name, cast(coalesce(n, 0) + 2 as bigint) as n
from (select name, unnest(generate_series(min(bucket), (select max(ts) from typed) - interval 90 minute,
        interval 30 minute)) as bucket from marked group by name) s
left join (select name, bucket, count(*) filter (where is_robot) as n from marked group by all) c
  on c.name = s.name and c.bucket = s.bucket
""",
    )
    q["stream_gauges"] = q["metric_gauge"]
    q["stream_latest"] = q["latest_n"]
    q["stream_numbered"] = q["running_count"]
    q["stream_every_nth"] = q["every_nth"]
    q["stream_once"] = _with(
        ["typed"],
        """
select epoch_us(bucket) as bucket, name, n from (
  select time_bucket(interval '1 hour', ts) as bucket, channel as name, count(*) as n from typed group by 1, 2
  union all
  select time_bucket(interval '1 hour', ts) as bucket, 'all-messages' as name, count(*) as n from typed group by 1)
""",
    )
    q["stream_score"] = _with(
        ["typed", "hourly", "profile"],
        f"""
select epoch_us(bucket) as bucket, channel, n, cluster, round(centre, 6) as centre,
  centre * cast(0.05 as double) < abs(n - centre) as is_anomaly
from (select s.bucket, s.channel, coalesce(h.n, 0) as n
      from (select channel, unnest(generate_series(min(bucket),
              (select max(bucket) from hourly where {_CLOSED}), interval 1 hour)) as bucket
            from hourly where {_CLOSED} group by channel) s
      left join hourly h on h.channel = s.channel and h.bucket = s.bucket) f
join profile using (channel)
qualify row_number() over (partition by bucket, channel order by abs(n - centre), cluster) = 1
""",
    )
    q["stream_store"] = _with(["stored"], f"select {_EDIT_MILLIS}, {_CALENDAR} from stored")
    q["stream_ingest"] = _with(["json_flags"], f"select {_JSON_EDIT} from json_flags where ok")
    q["dedupe_redelivery"] = q["edit_from_row"]
    q["total_messages"] = _with(["typed"], "select 'all-messages' as name, count(*) as n from typed")
    q["for_each_edit"] = q["edit_from_row"]
    return {name: sql.strip() for name, sql in q.items()}
