"""The error report run on the events, and what it left in its log and its outbox."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.catalog import operations_queries as oq
from folioflow.catalog import synthetic as syn
from folioflow.catalog.operations_queries import micro_time
from folioflow.plans.monitoring import ErrorReport
from folioflow.session import scratch_path


def _reported(spark: SparkSession, folder: str) -> ErrorReport:
    report = ErrorReport(
        spark, scratch_path(spark, "log"), scratch_path(spark, "outbox"), syn.OWN_CATEGORY, keep_days=20
    )
    report.run(syn.error_events(oq._events(spark, folder)), "daily", oq.LOG_DAY)
    return report


def logged_errors(spark: SparkSession, folder: str) -> DataFrame:
    """The log's files after a run: entries and latest time per level."""
    return _reported(spark, folder).logged().groupBy("log_file", "level").agg(
        F.count("*").alias("entries"), micro_time(F.max("ts")).alias("latest")
    )


def mailed_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The alert batches in the outbox after a run."""
    return _reported(spark, folder).mails().select(
        "channel", "opened", "sent", "events", "categories",
        micro_time("first_ts").alias("first_ts"), micro_time("last_ts").alias("last_ts"),
    )


QUERIES = {f.__name__: f for f in (logged_errors, mailed_alerts)}
ORACLE = {"logged_errors": oq.ORACLE["error_log"], "mailed_alerts": oq.ORACLE["alert_batches"]}
