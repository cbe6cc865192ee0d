"""Operators on a landing listing: ``path, modificationTime, creation_time, length``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.text import fold_case
from folioflow.functions.times import moment
from folioflow.operators.skew import keep_first

def non_empty(listing: DataFrame) -> DataFrame:
    return listing.where(F.col("length") > 0)


def from_day(listing: DataFrame, day: dt.date) -> DataFrame:
    """Files written or created on ``day``."""
    return listing.where(
        (F.to_date("modificationTime") == F.lit(day)) | (F.to_date("creation_time") == F.lit(day))
    )


def effective_time() -> Column:
    """The earlier of write and creation time; null when neither is known."""
    return F.least("modificationTime", "creation_time")


def with_effective_time(listing: DataFrame) -> DataFrame:
    return listing.withColumn("effective_time", effective_time())


def oldest_first(listing: DataFrame, limit: int | None = None) -> DataFrame:
    """Files by (effective time, path), those without a time last; with ``limit`` only the oldest so many.

    An hourly histogram tells first up to which hour the N oldest reach, so at most N files and
    those of one more hour are sorted; the N of them then pass one task.
    """
    timed = with_effective_time(listing)
    order = [F.col("effective_time").asc_nulls_last(), F.col("path").asc()]
    if limit is None:
        return timed.orderBy(*order)
    if limit < 1:
        raise ValueError("a limit is at least 1; None stands for no limit")
    # Files without a time count into the hour after all others.
    hour = F.coalesce(
        F.floor(F.unix_micros(F.col("effective_time").cast("timestamp")) / F.lit(3_600_000_000)),
        F.lit(2**62),
    )
    per_hour = timed.groupBy(hour.alias("hour")).agg(F.count("*").alias("files"))
    # One row per hour of history: small enough for a single ordered window.
    reached = per_hour.withColumn("so_far", F.sum("files").over(Window.orderBy("hour")))
    cutoff = reached.agg(F.min(F.when(F.col("so_far") >= limit, F.col("hour")))).scalar()
    return timed.where(hour <= F.coalesce(cutoff, F.lit(2**62))).orderBy(*order).limit(limit)


def backlog(
    listing: DataFrame, as_of: dt.datetime, max_age: dt.timedelta = dt.timedelta(0), max_files: int = 0
) -> DataFrame:
    """Files to look at again after a restart: recent enough, and at most ``max_files`` of them.

    A zero age or count, the defaults, is no bound. The oldest by (write time, path) are kept.
    """
    recent = listing
    if max_age > dt.timedelta(0):
        recent = recent.where(F.col("modificationTime") >= moment(as_of - max_age))
    if max_files <= 0:
        return recent
    only_written = recent.withColumn("_created", F.col("creation_time")).withColumn(
        "creation_time", F.lit(None).cast("timestamp_ntz")
    )
    kept = oldest_first(only_written, max_files)
    return kept.withColumn("creation_time", F.col("_created")).drop("_created", "effective_time")


def distinct_paths(arrivals: DataFrame, time: str = "modificationTime") -> DataFrame:
    """One row per path compared without case: the first that arrived."""
    return keep_first(
        arrivals.withColumn("_key", fold_case(F.col("path"))), ["_key"], [F.col(time), F.col("path")]
    ).drop("_key")
