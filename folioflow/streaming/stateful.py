"""Operators that carry state from one micro-batch to the next: attempts and alert batches.

State is a few numbers per path or channel plus the open batch. The rows one key brings in a
micro-batch are sorted in memory; the source's files per trigger bound them.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from folioflow.functions.text import fold_case
from folioflow.functions.times import seconds_of
from folioflow.operators.alerts import AlertRules

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Start queries with stateful processors inside: they need the RocksDB state store."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


class _Attempts(StatefulProcessor):
    """Failures in a row per path."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.failures = handle.getValueState("failures", "n int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["ts", "attempt_id"])
        stored = self.failures.get() if self.failures.exists() else None
        n, attempts = (stored[0] if stored else 0), []
        for success in batch["success"]:
            n = 0 if success else n % self.limit + 1
            attempts.append(n)
        self.failures.update((n,))
        failed = batch.assign(attempts=attempts)[~batch["success"].to_numpy(dtype=bool)]
        yield failed.assign(quarantined=failed["attempts"] == self.limit)[
            ["path", "ts", "attempt_id", "error", "attempts", "quarantined"]
        ]

    def close(self) -> None:
        pass


def number_attempts(outcomes: DataFrame, max_attempts: int = 3) -> DataFrame:
    """Stream form of the attempt count: ``path, ts, attempt_id, success, error`` in, failures out."""
    return (
        outcomes.withColumn("path_key", fold_case(F.col("path")))
        .groupBy("path_key")
        .transformWithStateInPandas(
            statefulProcessor=_Attempts(max(1, max_attempts)),
            outputStructType=(
                "path string, ts timestamp_ntz, attempt_id long, error string, attempts int, quarantined boolean"
            ),
            outputMode="Append",
            timeMode="None",
        )
    )


class _Batches(StatefulProcessor):
    """One channel's open batch and the time of its last one."""

    def __init__(self, rules: AlertRules):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", "second long, sent long, opened long, opened_rank long, rank long")
        self.open = handle.getListState("open", "event_id long, category string, ts timestamp_ntz")

    def _close(self, key, sent: int, opened: int, opened_rank: int) -> pd.DataFrame:
        held = list(self.open.get())
        self.open.clear()
        return pd.DataFrame(
            [(key[0], opened, opened_rank, sent, *event) for event in held],
            columns=["channel", "opened", "opened_rank", "sent", "event_id", "category", "ts"],
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        window, full, throttle = self.rules.waits
        second, sent, opened, opened_rank, rank = self.clock.get() if self.clock.exists() else (None,) * 5
        held = 0 if opened is None else sum(1 for _ in self.open.get())
        batch = pd.concat(list(rows)).sort_values(["ts", "event_id"])
        for event_id, category, ts, at in zip(batch["event_id"], batch["category"], batch["ts"], batch["second"]):
            at = int(at) if second is None else max(int(at), second)
            rank = rank + 1 if at == second else 0
            second = at
            if opened is not None and at >= opened + window:
                sent = opened + window
                yield self._close(key, sent, opened, opened_rank)
                opened = None
            if opened is None:
                if throttle and sent is not None and at - sent < throttle:
                    continue
                opened, opened_rank, held = at, 0 if throttle else rank, 0
            self.open.appendValue((int(event_id), category, ts.to_pydatetime()))
            held += 1
            if held >= full or window == 0:
                sent = at
                yield self._close(key, sent, opened, opened_rank)
                opened = None
        self.clock.update((second, sent, opened, opened_rank, rank))
        if opened is not None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            self.handle.registerTimer((opened + window) * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        second, sent, opened, opened_rank, rank = self.clock.get()
        due = expiredTimerInfo.getExpiryTimeInMs() // 1000
        if opened is not None and opened + self.rules.waits[0] <= due:
            yield self._close(key, due, opened, opened_rank)
            self.clock.update((second, due, None, None, rank))

    def close(self) -> None:
        pass


def batched_events(events: DataFrame, rules: AlertRules = AlertRules(), lateness: str = "10 seconds") -> DataFrame:
    """Stream form of alert batching; a batch comes out when it is full or its time is over.

    ``events`` holds ``channel, category, ts, event_id``. ``lateness`` is how long the watermark, and with
    it the end of a batch in a silent channel, waits behind the newest event. No event is dropped: one
    that comes later still is counted at its channel's current second.
    """
    timed = events.select("channel", "category", "ts", "event_id", seconds_of(F.col("ts")).alias("second"))
    # Timers run on event time, which Spark tracks on a zoned timestamp column.
    # The column goes once the watermark is set: where it is present, Spark drops late rows.
    marked = timed.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", lateness)
    marked = marked.drop("event_time")
    if not rules.enabled:
        marked = marked.where(F.lit(False))
    return marked.groupBy("channel").transformWithStateInPandas(
        statefulProcessor=_Batches(rules),
        outputStructType=(
            "channel string, opened long, opened_rank long, sent long, event_id long, category string, ts timestamp_ntz"
        ),
        outputMode="Append",
        timeMode="EventTime",
    )


def arrivals_per_interval(activity: DataFrame, minutes: int = 15, lateness: str = "1 hour") -> DataFrame:
    """Stream heartbeat: arrivals and last arrival per source and interval."""
    return (
        activity.withWatermark("arrived_at", lateness)
        .groupBy(F.window("arrived_at", f"{max(1, minutes)} minutes").alias("beat"), fold_case(F.col("source")).alias("source"))
        .agg(F.count("*").alias("arrived"), F.max("arrived_at").alias("last_arrival"))
        .select("source", F.col("beat.end").alias("beat_at"), "arrived", "last_arrival")
    )
