"""Queries on landing listings and reconciliation, with their SQL counterparts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.catalog import synthetic as syn
from folioflow.functions.names import (
    companion_of_pdf, file_name, guide_key_from_pdf, pdf_pattern_of_companion, relative_to,
)
from folioflow.functions.text import fold_case
from folioflow.functions.times import seconds_of
from folioflow.operators import listing, reconcile
from folioflow.session import scratch_path
from folioflow.sources.snapshots import ListingLog

DAY = dt.date(1998, 3, 15)
AS_OF = dt.datetime(2001, 8, 1, 12, 0, 0)


def text_time(ts: str) -> Column:
    """Whole seconds as text; formatting would go through the session's time zone."""
    return F.col(ts).cast("timestamp_ntz").cast("string")


def sql_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def _pdfs(spark: SparkSession, folder: str) -> DataFrame:
    return syn.pdf_listing(syn.orders(spark, folder))


def reconcile_guides(spark: SparkSession, folder: str) -> DataFrame:
    orders = syn.orders(spark, folder)
    pending = reconcile.pending_guides(syn.pdf_listing(orders), syn.registered_guides(orders))
    return pending.select("path", "guide_key", text_time("effective_time").alias("effective_time"))


def reconcile_guides_all(spark: SparkSession, folder: str) -> DataFrame:
    """Only active registered guides count."""
    orders = syn.orders(spark, folder)
    pending = reconcile.pending_guides(
        syn.pdf_listing(orders), syn.registered_guides(orders), max_files=None, active_only=True
    )
    return pending.select("path", "guide_key")


def reconcile_guides_limit_after(spark: SparkSession, folder: str) -> DataFrame:
    """The variant that takes registered guides out before the limit applies."""
    orders = syn.orders(spark, folder)
    pending = reconcile.pending_guides(
        syn.pdf_listing(orders), syn.registered_guides(orders), max_files=5000, limit_after=True
    )
    return pending.select("path", "guide_key")


def reconcile_counters(spark: SparkSession, folder: str) -> DataFrame:
    orders = syn.orders(spark, folder)
    candidates = reconcile.with_guide_keys(listing.oldest_first(syn.pdf_listing(orders)))
    keys = reconcile.registered_keys(syn.registered_guides(orders), "greName")
    return reconcile.run_counters(reconcile.mark_registered(candidates, F.col("guide_key"), keys), "guide_key")


def reconcile_invoices(spark: SparkSession, folder: str) -> DataFrame:
    orders = syn.orders(spark, folder)
    pending = reconcile.pending_invoices(
        syn.invoice_listing(orders), syn.registered_invoices(orders), syn.XML_ROOT
    )
    return pending.select("path", "name_file", text_time("effective_time").alias("effective_time"))


def work_list(spark: SparkSession, folder: str) -> DataFrame:
    orders = syn.orders(spark, folder)
    guides = reconcile.pending_guides(syn.pdf_listing(orders), syn.registered_guides(orders))
    invoices = reconcile.pending_invoices(
        syn.invoice_listing(orders), syn.registered_invoices(orders), syn.XML_ROOT
    )
    both = reconcile.work_list(guides, invoices)
    return both.groupBy("source", F.to_date("effective_time").cast("string").alias("day")).agg(
        F.count("*").alias("files")
    )


def guide_keys(spark: SparkSession, folder: str) -> DataFrame:
    name = file_name(F.col("path"))
    return _pdfs(spark, folder).select(
        "path", guide_key_from_pdf(name).alias("guide_key"), companion_of_pdf(name).alias("companion")
    )


def companion_patterns(spark: SparkSession, folder: str) -> DataFrame:
    records = syn.text_records(syn.orders(spark, folder))
    return records.select("path", pdf_pattern_of_companion(file_name(F.col("path"))).alias("pattern"))


def relative_paths(spark: SparkSession, folder: str) -> DataFrame:
    files = syn.invoice_listing(syn.orders(spark, folder))
    return files.select(
        "path",
        relative_to(F.col("path"), syn.XML_ROOT).alias("name_file"),
        relative_to(F.col("path"), "/landing/x").alias("cut_inside_name"),
        relative_to(F.col("path"), "/elsewhere").alias("other_root"),
    )


def todays_files(spark: SparkSession, folder: str) -> DataFrame:
    return listing.from_day(_pdfs(spark, folder), DAY).select("path", text_time("modificationTime").alias("written"))


def oldest_files(spark: SparkSession, folder: str) -> DataFrame:
    oldest = listing.oldest_first(_pdfs(spark, folder), 5000)
    return oldest.select("path", text_time("effective_time").alias("effective_time"))


def backlog_rescan(spark: SparkSession, folder: str) -> DataFrame:
    return listing.backlog(_pdfs(spark, folder), AS_OF, dt.timedelta(days=365), 5000).select(
        "path", text_time("modificationTime").alias("written")
    )


def non_empty_files(spark: SparkSession, folder: str) -> DataFrame:
    return listing.non_empty(_pdfs(spark, folder)).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    )


def distinct_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Each path of the attempts log once, whatever its case: the first arrival."""
    arrivals = syn.attempts(syn.table(spark, folder, "events"))
    first = listing.distinct_paths(arrivals, "ts")
    return first.select(
        fold_case(F.col("path")).alias("path_key"), "path", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("first_seen")
    )


def listing_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Change sets of three runs over a folder: one finds nothing old, one the changes, one nothing new."""
    pdfs = _pdfs(spark, folder).withColumn("s", seconds_of(F.col("modificationTime")))
    later = F.when(F.col("s") % 13 == 0, F.timestamp_add("HOUR", F.lit(1), F.col("modificationTime"))).otherwise(
        F.col("modificationTime")
    )
    before = pdfs.where(F.col("s") % 7 != 0)
    now = pdfs.where(F.col("s") % 11 != 0).withColumns(
        {"modificationTime": later, "length": F.col("length") + F.when(F.col("s") % 17 == 0, 1).otherwise(0)}
    )
    log = ListingLog(spark, scratch_path(spark, "listings"))
    sets = []
    for run, listed in enumerate((before, now, now), 1):
        sets.append(log.take(f"r{run}", listed).withColumn("run", F.lit(run).cast("long")))
        log.commit(f"r{run}", AS_OF)
        if run == 2:
            log.compact("folded", AS_OF)
    found = sets[0].unionByName(sets[1]).unionByName(sets[2])
    return found.select("run", "path", "change", text_time("modificationTime").alias("written"), "length")


QUERIES = {
    f.__name__: f
    for f in (
        reconcile_guides, reconcile_guides_all, reconcile_guides_limit_after, reconcile_counters, reconcile_invoices,
        work_list, guide_keys, companion_patterns, relative_paths, todays_files, oldest_files, backlog_rescan,
        non_empty_files, distinct_arrivals, listing_changes,
    )
}

_TIMED = syn.PDF_KEYS_SQL + """,
timed as (select *, least(mtime, coalesce(ctime, mtime)) as effective from keyed)"""
_KEYS = "select lower(\"greName\") from registered"
_INVOICES = """,
xml_timed as (select *, least(mtime, ctime) as effective, substr(path, 13) as name_file from xml_files)"""

ORACLE = {
    "reconcile_guides": f"""
with {_TIMED}, {syn.REGISTERED_SQL},
oldest as (select * from timed)
select path, guide_key, {sql_time('effective')} as effective_time from oldest
where guide_key is null or lower(guide_key) not in ({_KEYS})""",
    "reconcile_guides_all": f"""
with {_TIMED}, {syn.REGISTERED_SQL}
select path, guide_key from timed
where guide_key is null or lower(guide_key) not in ({_KEYS} where not deleted)""",
    "reconcile_guides_limit_after": f"""
with {_TIMED}, {syn.REGISTERED_SQL}
select path, guide_key from timed
where guide_key is null or lower(guide_key) not in ({_KEYS})
order by effective, path limit 5000""",
    "reconcile_counters": f"""
with {_TIMED}, {syn.REGISTERED_SQL},
oldest as (select * from timed),
marked as (select *, guide_key is not null and lower(guide_key) in ({_KEYS}) as registered from oldest)
select count(*) as candidates, count(*) filter (registered) as already_registered,
  count(*) filter (guide_key is null) as no_key, count(*) filter (not registered) as pending
from marked""",
    "reconcile_invoices": f"""
with {syn.PDF_SQL}, {syn.INVOICE_LISTING_SQL} {_INVOICES},
oldest as (select * from xml_timed)
select path, name_file, {sql_time('effective')} as effective_time from oldest where not registered""",
    "work_list": f"""
with {_TIMED}, {syn.REGISTERED_SQL}, {syn.INVOICE_LISTING_SQL} {_INVOICES},
g as (select * from timed),
i as (select * from xml_timed)
select source, strftime(effective, '%Y-%m-%d') as day, count(*) as files from (
  select 'guide' as source, effective from g where guide_key is null or lower(guide_key) not in ({_KEYS})
  union all
  select 'invoice' as source, effective from i where not registered
) group by 1, 2""",
    "listing_changes": f"""
with {syn.PDF_SQL},
timed as (select path, mtime, length, epoch(mtime)::bigint as s from pdf),
old as (select path, mtime, length from timed where s % 7 <> 0),
new as (
  select path, mtime + to_hours(case when s % 13 = 0 then 1 else 0 end) as mtime,
    length + case when s % 17 = 0 then 1 else 0 end as length
  from timed where s % 11 <> 0
),
found as (
  select 1 as run, path, 'new' as change, mtime, length from old
  union all
  select 2, path, 'new', mtime, length from new where path not in (select path from old)
  union all
  select 2, path, 'gone', mtime, length from old where path not in (select path from new)
  union all
  select 2, path, 'changed', n.mtime, n.length from new n join old o using (path)
  where n.mtime <> o.mtime or n.length <> o.length
)
select run::bigint as run, path, change, {sql_time('mtime')} as written, length::bigint as length from found""",
    "guide_keys": f"with {syn.PDF_KEYS_SQL} select path, guide_key, companion from keyed",
    "companion_patterns": f"""
with {syn.PDF_SQL}, {syn.TXT_SQL},
stem as (select path, string_split(regexp_extract(path, '([^/]*)\\.[^.]*$', 1), '-') as p from txt)
select path, case when len(p) = 3 and length(p[3]) = 7
  then p[1] || '-*-' || p[2] || '-?' || p[3] || '*.pdf' end as pattern from stem""",
    "relative_paths": f"""
with {syn.PDF_SQL}, {syn.INVOICE_LISTING_SQL}
select path, substr(path, 13) as name_file, substr(path, 11) as cut_inside_name, path as other_root from xml_files""",
    "todays_files": f"""
with {syn.PDF_SQL}
select path, {sql_time('mtime')} as written from pdf
where mtime::date = date '{DAY}' or ctime::date = date '{DAY}'""",
    "oldest_files": f"""
with {_TIMED}
select path, {sql_time('effective')} as effective_time from timed order by effective, path limit 5000""",
    "backlog_rescan": f"""
with {syn.PDF_SQL}
select path, {sql_time('mtime')} as written from pdf
where mtime >= timestamp '{AS_OF}' - to_days(365) order by mtime, path limit 5000""",
    "non_empty_files": f"""
with {syn.PDF_SQL}
select count(*) as files, sum(length)::bigint as bytes from pdf where length > 0""",
    "distinct_arrivals": """
with a as (
  select event_id, ts, case when event_id % 2 = 0 then upper(p) else p end as path
  from (select *, '/landing/xml/user_' || user_id::varchar || '.xml' as p from events)
)
select lower(path) as path_key, arg_min(path, ts) as path,
  strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as first_seen
from a group by 1""",
}
