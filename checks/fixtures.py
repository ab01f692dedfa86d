"""Projections of the given tables onto the shapes that the operators take.

One SQL text per projection, run by both engines: Spark binds the names in
braces to frames, the SQL side inlines them as common table expressions.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.operators.parse import calendar_fields, typed_edits
from editflow.session import scratch_path
from editflow.sources.lines import spread

EDITS = """
select event_id, ts, user_id,
  concat('#', event_type, '.wikipedia') as channel,
  concat('user', cast(user_id as varchar(20))) as user_name,
  cast(case when event_id % 3 = 0 then -floor(value) else floor(value) end as int) as delta,
  concat(case when event_id % 7 = 0 then '!' else '' end,
         case when event_id % 2 = 0 then 'M' else '' end,
         case when user_id % 5 = 0 then 'B' else '' end,
         case when event_id % 11 = 0 then 'N' else '' end) as flags,
  concat(case when event_id % 4 = 0 then 'Talk:' when event_id % 4 = 1 then 'User talk: ' else '' end,
         'Page ', cast(user_id as varchar(20))) as page,
  concat('https://wiki.example.org/w/index.php?diff=', cast(event_id as varchar(20))) as diff_url,
  concat('c', cast(event_id as varchar(20))) as edit_comment
from {events}
"""

IRC = """
select event_id, ts, channel,
  case when event_id % 50 = 0 then concat('garbage ', cast(event_id as varchar(20)))
  else concat(chr(3), '14[[', chr(3), '07', page, chr(3), '14]]', chr(3), '4 ', flags, chr(3), '10 ',
    chr(3), '02', diff_url, chr(3), ' ', chr(3), '5*', chr(3), ' ', chr(3), '03', user_name, chr(3), ' ',
    chr(3), '5*', chr(3), ' ',
    case when event_id % 13 = 0 then '(log)'
         when delta >= 0 then concat('(+', cast(delta as varchar(20)), ')')
         else concat('(', cast(delta as varchar(20)), ')') end,
    ' ', chr(3), '10', edit_comment, chr(3)) end as raw
from {edits_fx}
"""

JSON = """
select event_id, ts, channel,
  case when event_id % 50 = 0 then 'not json'
       when event_id % 50 = 1 then concat('{{"channel":"', channel, '"}}')
       when event_id % 50 = 2 then concat('{{"isRobot":"no","channel":"', channel, '","timestamp":"2024-01-01T00:00:00.000+01:00","flags":"","isUnpatrolled":false,"page":"p","diffUrl":"http://a.b/c","added":1,"deleted":0,"comment":"c","isNew":false,"isMinor":false,"delta":1,"user":"u","namespace":"Main"}}')
       when event_id % 50 = 3 then concat('{{"isRobot":false,"channel":"', channel, '","timestamp":"2024-01-01T00:00:00.000+01:00","flags":"","isUnpatrolled":false,"page":"p","diffUrl":"nourl","added":1,"deleted":0,"comment":"c","isNew":false,"isMinor":false,"delta":1,"user":"u","namespace":"Main"}}')
       else concat('{{"isRobot":', case when user_id % 5 = 0 then 'true' else 'false' end,
         ',"channel":"', channel, '","timestamp":"2024-01-', substring(cast(100 + event_id % 28 + 1 as varchar(20)), 2, 2), 'T12:30:00.000+01:00","flags":"',
         case when event_id % 3 = 0 then '' when event_id % 3 = 1 then 'M,B' else 'M,,B,,' end,
         '","isUnpatrolled":', case when event_id % 7 = 0 then 'true' else 'false' end,
         ',"page":"', page, '","diffUrl":"', diff_url, '","added":', cast(greatest(delta, 0) as varchar(20)),
         ',"deleted":', cast(greatest(-delta, 0) as varchar(20)), ',"comment":"', edit_comment,
         '","isNew":false,"isMinor":', case when event_id % 2 = 0 then 'true' else 'false' end,
         ',"delta":', cast(delta as varchar(20)), ',"user":"', user_name, '","namespace":"Main"}}') end as raw
from {edits_fx}
"""

METRICS = """
select event_id, ts, event_type as name, cast(floor(value) as int) as value, value as millis,
  concat(case when user_id % 3 = 0 then '+' when user_id % 3 = 1 then '-' else '' end,
         cast(cast(floor(value) as int) as varchar(20))) as setting,
  case when event_id % 4 = 0 then 0.5e0 else 1.0e0 end as rate,
  case event_id % 4 when 0 then 'c' when 1 then 'g' when 2 then 's' else 'ms' end as kind
from {events}
"""

SUBSCRIPTIONS = """
select * from (values ('s1', '#click.wikipedia'), ('s2', '#view.wikipedia'), ('s3', '#all.wikipedia'), ('s4', '#none.wikipedia')) as t(subscriber, channel)
"""

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


# The stream of events comes in so many batches, some events by DELAY later than their time.
BATCHES = 8
DELAY = "30 minutes"
# A watermark that no event of the stream comes later than.
WATERMARK = "1 hour"
# A delay that takes events into later batches, far beyond any watermark.
LONG_DELAY = "9 days"
ROWS_PER_FILE = 100_000


def event_stream(spark: SparkSession, sf_dir: str, delay: str = DELAY) -> DataFrame:
    """All events in BATCHES batches, one in ten of them late and so out of order."""
    path = scratch_path(spark, "events")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    late = F.when(F.col("event_id") % 10 == 0, F.expr(f"interval {delay}")).otherwise(F.expr("interval 0 minutes"))
    rows = rows.withColumn("_arrival", F.unix_micros(F.col("ts").cast("timestamp") + late))
    begin, end, total = rows.select(F.min("_arrival"), F.max("_arrival"), F.count("*")).first()
    place = F.floor((F.col("_arrival") - begin) * BATCHES / (end - begin + 1))
    # All batches have as many files, so that the stream takes one batch of files at a time.
    files = max(2, total // BATCHES // ROWS_PER_FILE)
    for batch in range(BATCHES):  # files are taken in the order in which they were written
        part = rows.where(place == batch).drop("_arrival").repartition(files)
        part.write.mode("append").parquet(path)
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", files)
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def irc_lines(rows: DataFrame) -> DataFrame:
    """Captured lines of an event frame or stream: event_id, ts, channel, raw."""
    spark = rows.sparkSession
    return spark.sql(IRC, edits_fx=spark.sql(EDITS, events=rows))


def json_records(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    return spark.sql(JSON, edits_fx=spark.sql(EDITS, events=rows))


def metric_events(rows: DataFrame) -> DataFrame:
    return rows.sparkSession.sql(METRICS, events=rows)


def subscriptions(spark: SparkSession) -> DataFrame:
    return spark.sql(SUBSCRIPTIONS)


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_edits(irc_lines(events(spark, sf_dir)))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_fields(edits(spark, sf_dir))
