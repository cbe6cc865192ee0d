"""Files and tables written next to the registry: routed PDFs, quarantine, daily error log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.names import file_name
from folioflow.operators.alerts import loggable
from folioflow.sinks.copies import copy_files
from folioflow.sources.landing import PDF_FILES, read_content
from folioflow.sources.stores import reachable

DEFAULT_LOG_PREFIX = "errors"


def copy_routed(spark: SparkSession, accepted: DataFrame, pdf_folder: str, target: str, batch_id: str) -> DataFrame:
    """Copy the PDFs of accepted guides to the folder of their route below ``target``; returns those copied.

    Guides whose PDF could not be copied are not in the result and must not be registered. Where tasks
    can't open files themselves, contents go to a table of the batch instead, partitioned by route.
    """
    if reachable(pdf_folder) and reachable(target):
        place = F.concat_ws("/", F.lit(target.rstrip("/")), F.col("route"), file_name(F.col("path")))
        copied = copy_files(accepted.select("path", place.alias("target"), "length")).where("error is null")
    else:
        contents = read_content(spark, pdf_folder, PDF_FILES, accepted, "route")
        out = f"{target.rstrip('/')}/copy={batch_id}"
        named = contents.select("route", "path", file_name(F.col("path")).alias("name"), "content")
        named.write.mode("overwrite").partitionBy("route").parquet(out)
        copied = spark.read.schema("path string, name string, content binary, route string").parquet(out)
    return accepted.join(copied.select("path"), "path", "left_semi")


def write_quarantine(rows: DataFrame, target: str, batch_id: str) -> None:
    """Dead-letter rows (:func:`quarantine_rows`) below one folder per day."""
    rows.write.mode("overwrite").partitionBy("day").parquet(f"{target.rstrip('/')}/batch={batch_id}")


def quarantined_before(spark: SparkSession, target: str, batch_id: str) -> DataFrame:
    """``attempt_id`` of all dead-letter rows of other batches; none if there is no such folder yet."""
    stored = _dead_letters(spark, target, "attempt_id string, batch string")
    return stored.where(F.col("batch") != batch_id).select("attempt_id").distinct()


def quarantined_files(spark: SparkSession, target: str) -> DataFrame:
    """``path, modificationTime, length`` of all dead-letter rows; none if there is no such folder yet."""
    return _dead_letters(spark, target, "path string, modificationTime timestamp_ntz, length long")


def _dead_letters(spark: SparkSession, target: str, schema: str) -> DataFrame:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(target)


def log_entries(events: DataFrame, prefix: str = "") -> DataFrame:
    """Entries of the daily error log: warnings and worse, with the file each one goes to."""
    stem = prefix.strip() or DEFAULT_LOG_PREFIX
    return loggable(events).withColumn("day", F.to_date("ts")).withColumn(
        "log_file", F.concat(F.lit(f"{stem}-"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".log"))
    )


def within_retention(entries: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """Entries whose day is kept; zero or fewer days keep everything."""
    return entries if days <= 0 else entries.where(F.col("day") >= F.lit(as_of - dt.timedelta(days=days)))


def write_log(entries: DataFrame, target: str, batch_id: str) -> None:
    """Entries below one folder per day and batch; a batch that is written again replaces itself."""
    (
        entries.withColumn("batch", F.lit(batch_id))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(target)
    )


def expire_log(spark: SparkSession, target: str, as_of: dt.date, days: int) -> list[str]:
    """Delete the day folders older than the retention; one folder per day, so the list is short."""
    if days <= 0:
        return []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(target)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    oldest = (as_of - dt.timedelta(days=days)).isoformat()
    expired = []
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("day=") and name[4:] < oldest:
            files.delete(entry.getPath(), True)
            expired.append(name[4:])
    return sorted(expired)
