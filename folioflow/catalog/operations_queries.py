"""Queries on attempts, quarantine, logs, alerts and status, with their SQL counterparts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.catalog import synthetic as syn
from folioflow.operators import alerts, attempts, status
from folioflow.operators.alerts import AlertRules
from folioflow.sinks.files import log_entries, within_retention

LOG_DAY = dt.date(2024, 1, 30)
DENSE = AlertRules(window=3600, max_batch=3, throttle=5400)
UNTHROTTLED = AlertRules(window=7200, max_batch=4, throttle=0)
SINGLE = AlertRules(window=0, max_batch=50, throttle=1800)
BEAT_MINUTES = 60


def micro_time(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sql_micro_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return syn.table(spark, folder, "events")


def _alerts(spark: SparkSession, folder: str) -> DataFrame:
    return alerts.alertable(syn.error_events(_events(spark, folder)), syn.OWN_CATEGORY)


def failed_attempts(spark: SparkSession, folder: str) -> DataFrame:
    numbered = attempts.number_attempts(syn.attempts(_events(spark, folder)))
    return numbered.select("attempt_id", F.col("attempts").cast("long").alias("attempts"), "quarantined")


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    rows = attempts.quarantine_rows(attempts.number_attempts(syn.attempts(_events(spark, folder)), 2))
    return rows.select(
        F.col("day").cast("string").alias("day"), "stored_as", "path", "error",
        F.col("attempts").cast("long").alias("attempts"),
    )


def circulating_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of the attempt log, as last written, that are not in quarantine; each is written anew every day."""
    written, size = F.date_trunc("day", "ts").cast("timestamp_ntz"), 1000 + F.dayofmonth("ts").cast("long")
    log = syn.attempts(_events(spark, folder)).withColumns({"modificationTime": written, "length": size})
    dead = attempts.quarantine_rows(attempts.number_attempts(log, 2))
    now = log.groupBy(F.lower("path").alias("path")).agg(F.max("modificationTime").alias("modificationTime"), F.max("length").alias("length"))
    return attempts.in_circulation(now, dead).select("path", F.col("modificationTime").cast("string").alias("written"), "length")


def alertable_events(spark: SparkSession, folder: str) -> DataFrame:
    return _alerts(spark, folder).groupBy("channel", "category", "level").agg(F.count("*").alias("events"))


def error_log(spark: SparkSession, folder: str) -> DataFrame:
    entries = within_retention(log_entries(syn.error_events(_events(spark, folder))), LOG_DAY, 20)
    return entries.groupBy("log_file", "level").agg(F.count("*").alias("entries"), micro_time(F.max("ts")).alias("latest"))


def alert_buffer(spark: SparkSession, folder: str) -> DataFrame:
    return alerts.newest(_alerts(spark, folder), ["channel"]).select("channel", "event_id")


def _summary(spark: SparkSession, folder: str, rules: AlertRules) -> DataFrame:
    summary = alerts.batch_summary(alerts.batched_events(_alerts(spark, folder), rules))
    return summary.select(
        "channel", "opened", "sent", "events", "categories",
        micro_time("first_ts").alias("first_ts"), micro_time("last_ts").alias("last_ts"),
    )


def alert_batches(spark: SparkSession, folder: str) -> DataFrame:
    return _summary(spark, folder, AlertRules())


def alert_batches_dense(spark: SparkSession, folder: str) -> DataFrame:
    """Long windows, small batches: most batches close because they are full."""
    return _summary(spark, folder, DENSE)


def alert_batches_single(spark: SparkSession, folder: str) -> DataFrame:
    """No aggregation window: one event per batch, the rest throttled."""
    return _summary(spark, folder, SINGLE)


def alert_batches_unthrottled(spark: SparkSession, folder: str) -> DataFrame:
    """Nothing is dropped: every event ends up in a batch."""
    return _summary(spark, folder, UNTHROTTLED)


def alert_categories(spark: SparkSession, folder: str) -> DataFrame:
    counts = alerts.category_counts(alerts.batched_events(_alerts(spark, folder), UNTHROTTLED))
    return counts.select(
        "channel", "opened", "opened_rank", "category", "events", F.col("position").cast("long").alias("position")
    )


def source_status(spark: SparkSession, folder: str) -> DataFrame:
    current = status.source_status(syn.activity(_events(spark, folder)))
    return current.select("source", "pending", micro_time("last_processed").alias("last_processed"), "active")


def heartbeats(spark: SparkSession, folder: str) -> DataFrame:
    beats = status.heartbeats(syn.activity(_events(spark, folder)), BEAT_MINUTES)
    return beats.select(
        "source", F.date_format("beat_at", "yyyy-MM-dd HH:mm:ss").alias("beat_at"), "pending",
        micro_time("last_processed").alias("last_processed"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        failed_attempts, quarantine, circulating_files, alertable_events, error_log, alert_buffer, alert_batches, alert_batches_dense,
        alert_batches_single, alert_batches_unthrottled, alert_categories, source_status, heartbeats,
    )
}


def _attempts(limit: int) -> str:
    return f"""
attempt as (
  select event_id as attempt_id, ts, case when event_id % 2 = 0 then upper(p) else p end as path,
    event_type = 'signup' as success, 'failed on ' || event_type as error
  from (select *, '/landing/xml/user_' || user_id::varchar || '.xml' as p from events)
),
era as (
  select *, sum(success::int) over (partition by lower(path) order by ts, attempt_id) as era from attempt
),
failure as (
  select *, (row_number() over (partition by lower(path), era order by ts, attempt_id) - 1) % {limit} + 1 as attempts
  from era where not success
)"""


def throttled_sql(rules: AlertRules) -> str:
    """Openers found one after the other per channel, on counts per second."""
    close = (
        f"coalesce(min(b.second) filter (b.so_far >= a.so_far - a.n + {rules.max_batch}), a.second + {rules.window})"
        if rules.window
        else "a.second"
    )
    size = rules.max_batch if rules.window else 1
    return f"""{syn.EVENT_SQL},
cells as (
  select *, sum(n) over (partition by channel order by second) as so_far
  from (select channel, second, count(*) as n from alert group by 1, 2)
),
step as (
  select a.channel, a.second, {close} as sent
  from cells a join cells b on a.channel = b.channel
    and b.second >= a.second and b.second < a.second + {max(rules.window, 1)}
  group by a.channel, a.second, a.so_far, a.n
),
following as (
  select s.channel, s.second, s.sent, c.second as next_second
  from step s asof left join cells c on s.channel = c.channel and s.sent + {rules.throttle} <= c.second
),
opener as (
  select f.* from following f join (select channel, min(second) as second from cells group by 1) using (channel, second)
  union all
  select f.* from opener o join following f on f.channel = o.channel and f.second = o.next_second
),
member as (
  select a.*, o.second as opened, o.sent,
    row_number() over (partition by o.channel, o.second order by a.ts, a.event_id) as place
  from opener o join alert a on a.channel = o.channel
    and a.second >= o.second and a.second < o.second + {max(rules.window, 1)}
),
batched as (select *, 0 as opened_rank from member where place <= {size})"""


def unthrottled_sql(rules: AlertRules) -> str:
    return f"""{syn.EVENT_SQL},
placed as (
  select *, row_number() over (partition by channel order by ts, event_id) as place,
    row_number() over (partition by channel, second order by ts, event_id) - 1 as opened_rank
  from alert
),
step as (
  select a.channel, a.place, a.second as opened, a.opened_rank, max(b.place) as last_place,
    case when count(*) = {rules.max_batch} then max(b.second) else a.second + {rules.window} end as sent
  from placed a join placed b on a.channel = b.channel and b.second < a.second + {rules.window}
    and b.place >= a.place and b.place < a.place + {rules.max_batch}
  group by a.channel, a.place, a.second, a.opened_rank
),
opener as (
  select * from step where place = 1
  union all
  select s.* from opener o join step s on s.channel = o.channel and s.place = o.last_place + 1
),
batched as (
  select p.* exclude (opened_rank), o.opened, o.opened_rank, o.sent
  from opener o join placed p on p.channel = o.channel and p.place between o.place and o.last_place
)"""


_SUMMARY = f"""
select channel, opened, sent, count(*) as events, count(distinct category) as categories,
  {sql_micro_time('min(ts)')} as first_ts, {sql_micro_time('max(ts)')} as last_ts
from batched group by channel, opened, opened_rank, sent"""

_ACTIVITY = """
activity as (
  select event_type as source, '/landing/f' || (event_id % 5000)::varchar as path, ts as arrived_at,
    case when value < 25 then ts + to_seconds(user_id * 60) end as processed_at, event_type <> 'view' as active
  from events
)"""

ORACLE = {
    "failed_attempts": f"with {_attempts(3)} select attempt_id, attempts, attempts = 3 as quarantined from failure",
    "circulating_files": f"""
with {_attempts(2)},
held as (select distinct lower(path) as path, ts::date as day from failure where attempts = 2),
latest as (select lower(path) as path, max(ts::date) as day from attempt group by 1)
select path, strftime(day, '%Y-%m-%d %H:%M:%S') as written, 1000 + day(day) as length
from latest where (path, day) not in (select path, day from held)""",
    "quarantine": f"""
with {_attempts(2)},
ended as (
  select *, ts::date as day, regexp_extract(path, '[^/]*$') as name,
    row_number() over (partition by ts::date, lower(path) order by ts, attempt_id) as clash
  from failure where attempts = 2
)
select day::varchar as day, case when clash = 1 then name
    else regexp_replace(name, '\\.[^.]*$', '') || '.' || strftime(ts, '%H%M%S%g') || regexp_extract(name, '\\.[^.]*$') end as stored_as,
  path, error, attempts from ended""",
    "alertable_events": f"""
with {syn.EVENT_SQL} select channel, category, level, count(*) as events from alert group by 1, 2, 3""",
    "error_log": f"""
with {syn.EVENT_SQL}
select 'errors-' || strftime(ts, '%Y-%m-%d') || '.log' as log_file, level, count(*) as entries,
  {sql_micro_time('max(ts)')} as latest
from log where level in ('Warning', 'Error', 'Critical') and ts::date >= date '{LOG_DAY - dt.timedelta(days=20)}'
group by 1, 2""",
    "alert_buffer": f"""
with {syn.EVENT_SQL}
select channel, event_id from (
  select *, row_number() over (partition by channel order by ts desc, event_id desc) as age from alert
) where age <= 500""",
    "alert_batches": f"with recursive {throttled_sql(AlertRules())} {_SUMMARY}",
    "alert_batches_dense": f"with recursive {throttled_sql(DENSE)} {_SUMMARY}",
    "alert_batches_single": f"with recursive {throttled_sql(SINGLE)} {_SUMMARY}",
    "alert_batches_unthrottled": f"with recursive {unthrottled_sql(UNTHROTTLED)} {_SUMMARY}",
    "alert_categories": f"""
with recursive {unthrottled_sql(UNTHROTTLED)}
select channel, opened, opened_rank, category, events,
  row_number() over (partition by channel, opened, opened_rank order by events desc, seen, seen_id) as position
from (
  select channel, opened, opened_rank, category, count(*) as events, min(ts) as seen, arg_min(event_id, ts) as seen_id
  from batched group by 1, 2, 3, 4
)""",
    "source_status": f"""
with {_ACTIVITY}
select lower(source) as source, count(distinct path) filter (processed_at is null) as pending,
  {sql_micro_time('max(processed_at)')} as last_processed, bool_or(active) as active
from activity group by 1""",
    "heartbeats": f"""
with {_ACTIVITY},
change as (
  select source, time_bucket(interval '{BEAT_MINUTES} minutes', arrived_at, timestamp '1970-01-01') as tick, 1 as d,
    null::timestamp as processed_at from activity
  union all
  select source, time_bucket(interval '{BEAT_MINUTES} minutes', processed_at, timestamp '1970-01-01'), -1, processed_at
  from activity where processed_at is not null
),
beat as (
  select source, unnest(generate_series(min(tick), max(tick), interval '{BEAT_MINUTES} minutes')) as tick
  from change group by 1
)
select b.source, strftime(b.tick + interval '{BEAT_MINUTES} minutes', '%Y-%m-%d %H:%M:%S') as beat_at,
  sum(c.d)::bigint as pending, {sql_micro_time('max(c.processed_at)')} as last_processed
from beat b join change c on c.source = b.source and c.tick <= b.tick group by b.source, b.tick""",
}
