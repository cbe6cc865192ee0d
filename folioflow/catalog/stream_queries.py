"""The same operators on streams: the event table is read as a file stream until it is drained."""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.catalog import operations_queries as ops
from folioflow.catalog import synthetic as syn
from folioflow.functions.times import moment
from folioflow.operators import alerts
from folioflow.operators.alerts import AlertRules
from folioflow.operators.listing import non_empty
from folioflow.session import cut_lineage, scratch_path
from folioflow.streaming import ingest, matching, remainders, stateful

LATENESS = 10
STRETCH = 500
STREAM_RULES = AlertRules(window=3600, max_batch=3, throttle=5400)


def _stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = syn.table(spark, folder, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)


def drained(
    spark: SparkSession, name: str, build: Callable[[], DataFrame],
    remainder: Callable[[SparkSession, str], DataFrame] | None = None, processors: bool = True,
) -> DataFrame:
    """Run a stream until its input is used up; its output, written to the shared folder.

    ``remainder`` reads what the state still holds then, and is added to the output. Without stateful ``processors``
    the session's own kind of state store will do.
    """
    out = scratch_path(spark, name)
    with stateful.rocksdb_state(spark) if processors else contextlib.nullcontext():
        stream = build()
        query = (
            stream.writeStream.outputMode("append")
            .option("checkpointLocation", f"{out}/state")
            .trigger(availableNow=True)
            .format("parquet")
            .start(f"{out}/rows")
        )
        query.awaitTermination()
        rows = spark.read.schema(stream.schema).parquet(f"{out}/rows")
        # The state is read here, while the session names its kind of store.
        return rows if remainder is None else rows.unionByName(cut_lineage(remainder(spark, f"{out}/state")))


def stream_failed_attempts(spark: SparkSession, folder: str) -> DataFrame:
    rows = drained(
        spark, "attempts", lambda: stateful.number_attempts(syn.attempts(_stream(spark, folder)))
    )
    return rows.select("attempt_id", F.col("attempts").cast("long").alias("attempts"), "quarantined")


def stream_alert_batches(spark: SparkSession, folder: str) -> DataFrame:
    rows = drained(
        spark, "alerts",
        lambda: stateful.batched_events(
            alerts.alertable(syn.error_events(_stream(spark, folder)), syn.OWN_CATEGORY), STREAM_RULES,
            f"{LATENESS} seconds",
        ),
        lambda session, state: remainders.open_batches(session, state, STREAM_RULES),
    )
    summary = alerts.batch_summary(rows)
    return summary.select(
        "channel", "opened", "sent", "events", "categories",
        ops.micro_time("first_ts").alias("first_ts"), ops.micro_time("last_ts").alias("last_ts"),
    )


def stream_distinct_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    rows = drained(
        spark, "arrivals",
        lambda: ingest.distinct_arrivals(
            syn.attempts(_stream(spark, folder)).withColumn("ts", F.col("ts").cast("timestamp")), "ts", "40 days"
        ),
    )
    return rows.select(F.lower("path").alias("path_key"))


def stream_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Heartbeat counts per source and interval, the last ones from what is still open."""
    def build() -> DataFrame:
        activity = syn.activity(_stream(spark, folder)).withColumn("arrived_at", F.col("arrived_at").cast("timestamp"))
        return stateful.arrivals_per_interval(activity, 60, "1 hour")

    rows = drained(spark, "beats", build, remainders.open_intervals)
    return rows.select(
        "source", F.date_format("beat_at", "yyyy-MM-dd HH:mm:ss").alias("beat_at"), "arrived",
        ops.micro_time("last_arrival").alias("last_arrival"),
    )


def _arriving(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """Rows as a stream in several micro-batches, in the order of ``arrived_at`` but for stretches of ``STRETCH`` days."""
    target = scratch_path(spark, name)
    first, last = rows.agg(F.min("arrived_at"), F.max("arrived_at")).first()
    while first is not None and first <= last:
        end = first + dt.timedelta(days=STRETCH)
        part = rows.where((F.col("arrived_at") >= moment(first)) & (F.col("arrived_at") < moment(end)))
        part.write.mode("append").parquet(target)
        first = end
    written = spark.read.parquet(target)
    stream = spark.readStream.schema(written.schema).option("maxFilesPerTrigger", -(-len(written.inputFiles()) // 5))
    return stream.parquet(target).withColumn("arrived_at", F.col("arrived_at").cast("timestamp"))


def stream_matched_records(spark: SparkSession, folder: str) -> DataFrame:
    """PDFs and text records from two streams, matched when both have come within two days of each other."""
    orders = syn.orders(spark, folder)
    pdfs = non_empty(syn.pdf_listing(orders)).select("path", F.col("modificationTime").alias("arrived_at"))
    texts = non_empty(syn.text_records(orders).select("record_id", "path", "length"))
    delay = F.col("k") * 13 % (3 * 86400)
    landed = orders.select(F.col("k").alias("record_id"), F.timestamp_add("SECOND", delay, F.col("o_orderdate")).alias("arrived_at"))
    records = texts.join(landed, "record_id").select("path", "arrived_at")

    def build() -> DataFrame:
        arrived = _arriving(spark, "records", records).withColumn("record", F.struct("path"))
        return matching.matched_records(_arriving(spark, "pdfs", pdfs), arrived, "2 days", f"{STRETCH} days").select(
            "path", "guide_key", F.col("record.path").alias("record")
        )

    rows = drained(
        spark, "matches", build,
        lambda session, state: remainders.open_pdfs(session, state).select(
            "path", "guide_key", F.lit(None).cast("string").alias("record")
        ),
        processors=False,
    )
    return rows


QUERIES = {
    f.__name__: f
    for f in (
        stream_failed_attempts, stream_alert_batches, stream_distinct_arrivals, stream_arrivals, stream_matched_records,
    )
}

ORACLE = {
    "stream_failed_attempts": ops.ORACLE["failed_attempts"],
    "stream_alert_batches": f"with recursive {ops.throttled_sql(STREAM_RULES)} {ops._SUMMARY}",
    "stream_distinct_arrivals": """
select distinct '/landing/xml/user_' || user_id::varchar || '.xml' as path_key from events""",
    "stream_matched_records": f"""
with {syn.PDF_KEYS_SQL}, {syn.TXT_SQL},
landed as (
  select lower(regexp_extract(t.path, '[^/]*$')) as name, t.path, o.o_orderdate + to_seconds(o.o_orderkey * 13 % 259200) as at
  from txt t join orders o on o.o_orderkey = t.record_id where t.value <> ''
)
select p.path, p.guide_key, l.path as record
from keyed p left join landed l on l.name = lower(p.companion)
  and l.at between p.mtime - interval 2 days and p.mtime + interval 2 days
where p.length > 0""",
    "stream_arrivals": f"""
select source, strftime(beat + interval 60 minutes, '%Y-%m-%d %H:%M:%S') as beat_at, count(*) as arrived,
  {ops.sql_micro_time('max(ts)')} as last_arrival
from (select event_type as source, ts, time_bucket(interval '60 minutes', ts, timestamp '1970-01-01') as beat from events)
group by source, beat""",
}
