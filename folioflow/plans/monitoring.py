"""The job on error events: the daily log with its retention, and the outbox of alert batches."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators.alerts import AlertRules, alertable, batch_summary, batched_events, category_counts
from folioflow.session import cut_lineage
from folioflow.sinks.files import expire_log, log_entries, within_retention, write_log

#: The outbox: one row per alert batch, its categories with the most events first.
OUTBOX = (
    "channel string, opened long, opened_rank long, events long, categories long, first_ts timestamp_ntz, "
    "last_ts timestamp_ntz, sent long, counted array<struct<position:int,category:string,events:long>>"
)


@dataclass(frozen=True)
class ErrorReport:
    """Writes the error events of a run to ``log`` and what is to be mailed of them to ``outbox``.

    ``own_prefix`` begins the mailer's own categories, which are logged but never mailed. Entries older
    than ``keep_days`` are not written and their day folders go; zero keeps everything. Events of a
    run are batched on their own: what is open at its end is sent with it. Streams carry it over
    (``streaming/stateful.py``).
    """

    spark: SparkSession
    log: str
    outbox: str
    own_prefix: str
    rules: AlertRules = AlertRules()
    keep_days: int = 0

    def run(self, events: DataFrame, batch_id: str, as_of: dt.date) -> DataFrame:
        """One row of counters: logged and mailed events, batches. A run under the same id replaces itself."""
        write_log(within_retention(log_entries(events), as_of, self.keep_days), self.log, batch_id)
        expire_log(self.spark, self.log, as_of, self.keep_days)
        batched = cut_lineage(batched_events(alertable(events, self.own_prefix), self.rules))
        key = ["channel", "opened", "opened_rank"]
        counted = category_counts(batched).groupBy(*key).agg(
            F.array_sort(F.collect_list(F.struct("position", "category", "events"))).alias("counted")
        )
        mails = batch_summary(batched).join(counted, key)
        mails.write.mode("overwrite").parquet(f"{self.outbox.rstrip('/')}/batch={batch_id}")
        logged = self.logged().where(F.col("batch") == batch_id).agg(F.count("*").alias("logged"))
        mailed = self.mails().where(F.col("batch") == batch_id).agg(
            F.coalesce(F.sum("events"), F.lit(0)).alias("mailed"), F.count("*").alias("batches")
        )
        return logged.crossJoin(mailed)

    def logged(self) -> DataFrame:
        """All entries that the log holds, with ``day`` and ``batch``."""
        schema = "category string, level string, message string, ts timestamp_ntz, log_file string, day date, batch string"
        return self.spark.read.schema(schema).parquet(self.log)

    def mails(self) -> DataFrame:
        """All alert batches of the outbox, with ``batch``, the run that sent them."""
        return self.spark.read.schema(f"{OUTBOX}, batch string").parquet(self.outbox)
