"""State of the document sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.text import fold_case
from folioflow.functions.times import at_second, seconds_of


def source_status(activity: DataFrame) -> DataFrame:
    """Pending files, last processing time and activity per source name (without case).

    ``activity`` holds ``source, path, arrived_at, processed_at, active``; a path in flight
    several times is pending once.
    """
    pending = F.when(F.col("processed_at").isNull(), fold_case(F.col("path")))
    return activity.groupBy(fold_case(F.col("source")).alias("source")).agg(
        F.count_distinct(pending).alias("pending"),
        F.max("processed_at").alias("last_processed"),
        F.bool_or("active").alias("active"),
    )


def heartbeats(activity: DataFrame, minutes: int = 15) -> DataFrame:
    """Status of every source at the end of every interval between its first and last activity.

    Arrivals and completions are counted per source and interval first; the running sums then see
    one row per interval, however many files there are.
    """
    every = max(1, minutes)

    def interval(name: str):
        return F.floor(seconds_of(F.col(name)) / (every * 60)).cast("long")

    source = fold_case(F.col("source")).alias("source")
    arrived = activity.select(
        source, interval("arrived_at").alias("tick"), F.lit(1).alias("change"),
        F.lit(None).cast("timestamp_ntz").alias("processed_at"),
    )
    done = activity.where(F.col("processed_at").isNotNull()).select(
        source, interval("processed_at").alias("tick"), F.lit(-1).alias("change"), "processed_at"
    )
    per_tick = arrived.unionByName(done).groupBy("source", "tick").agg(
        F.sum("change").alias("change"), F.max("processed_at").alias("processed_at")
    )
    ticks = per_tick.groupBy("source").agg(F.min("tick").alias("_a"), F.max("tick").alias("_b")).select(
        "source", F.explode(F.sequence("_a", "_b")).alias("tick")
    )
    so_far = Window.partitionBy("source").orderBy("tick")
    return ticks.join(per_tick, ["source", "tick"], "left").select(
        "source",
        at_second((F.col("tick") + 1) * every * 60).alias("beat_at"),
        F.sum(F.coalesce("change", F.lit(0))).over(so_far).alias("pending"),
        F.max("processed_at").over(so_far).alias("last_processed"),
    )
