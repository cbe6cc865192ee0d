"""What a drained stream still holds: batches and intervals that no later event has closed.

A stream hands out a batch when it is full or its time is over. When input ends, the last ones are in the state only;
the state is a table like any other and is read as one, so a replay of a day gives all of the day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators.alerts import AlertRules


def state_of(spark: SparkSession, checkpoint: str, variable: str | None = None, **options: str) -> DataFrame:
    """Rows of a query's state after its last batch; ``variable`` is one of a stateful processor's."""
    reader = spark.read.format("statestore").options(**options)
    return (reader if variable is None else reader.option("stateVarName", variable)).load(checkpoint)


def open_batches(spark: SparkSession, checkpoint: str, rules: AlertRules = AlertRules()) -> DataFrame:
    """Events of the open alert batches, as :func:`stateful.batched_events` would hand them out at the end of
    their time."""
    clock = state_of(spark, checkpoint, "clock").select(F.col("key.channel").alias("channel"), "value.*")
    clock = clock.where("opened is not null")
    held = state_of(spark, checkpoint, "open").select(F.col("key.channel").alias("_channel"), "list_element.*")
    met = F.col("channel").eqNullSafe(F.col("_channel"))
    return held.join(clock, met).select(
        "channel", "opened", "opened_rank", (F.col("opened") + rules.waits[0]).alias("sent"), "event_id", "category", "ts"
    )


def open_pdfs(spark: SparkSession, checkpoint: str) -> DataFrame:
    """PDFs that have met no record so far, as :func:`matching.matched_records` would hand them out at the end of
    their time, but for the ``record``."""
    waiting = state_of(spark, checkpoint, storeName="left-keyWithIndexToValue").where("not value.matched")
    return waiting.select("value.*").drop("matched", "_pdf")


def open_intervals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Heartbeat intervals that the watermark has not closed, as :func:`stateful.arrivals_per_interval` counts them."""
    state = state_of(spark, checkpoint)
    beat, source = (F.col("key")[name] for name in state.schema["key"].dataType.names)
    arrived, last = (F.col("value")[name] for name in state.schema["value"].dataType.names[-2:])
    return state.select(
        source.alias("source"), beat["end"].alias("beat_at"), arrived.alias("arrived"), last.alias("last_arrival")
    )
