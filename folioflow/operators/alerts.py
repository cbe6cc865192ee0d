"""Error alerts: which events count, how they are batched and throttled, and what a batch says.

The rules form a chain: the first event opens a batch, the batch closes after a time or when it
is full, and for a while after it was sent events are dropped one by one. Where the next batch
opens depends on when the last one was sent, so a channel looks like a task for one worker. Two
facts make it parallel. The clock ticks in whole seconds, so the chain runs on counts per channel
and second, which are aggregated before the shuffle; and what one day hands on to the next is only
the second from which a batch may open, one of window + throttle + 1 values. Each day is therefore
solved for all of them on its own, the days are linked through these small tables, and then each
day writes its batches.

Without throttle nothing is dropped, and the next batch opens at the event after the last. Then a block is
a stretch of events instead of a day: a batch takes at most so many events, so the first of a block opens at
one of as many places, and what a block hands on is again a small table. Tables of neighbouring blocks are
composed in groups, groups of groups and so on, so no task ever sees all blocks of a channel.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.times import seconds_of
from folioflow.operators.skew import in_blocks, run_length, running_total
from folioflow.schemas import LEVELS
from folioflow.session import cut_lineage

DAY = 86_400
BUFFER_CAPACITY = 500
#: Events of a block when there is no throttle, and blocks whose tables are composed at a time.
BLOCK_EVENTS, FAN = 50_000, 64


@dataclass(frozen=True)
class AlertRules:
    """Seconds a batch stays open, events it takes, and seconds of silence after it was sent."""

    window: int = 60
    max_batch: int = 50
    throttle: int = 120
    enabled: bool = True

    @property
    def waits(self) -> tuple[int, int, int]:
        return max(0, self.window), max(1, self.max_batch), max(0, self.throttle)


def level_rank(level: Column) -> Column:
    return F.array_position(F.array(*(F.lit(name.lower()) for name in LEVELS)), F.lower(level))


def alertable(events: DataFrame, own_prefix: str) -> DataFrame:
    """Events of level Error or above; the mailer's own categories would feed back and are left out."""
    return events.where(
        (level_rank(F.col("level")) >= LEVELS.index("Error") + 1)
        & ~F.startswith(F.col("category"), F.lit(own_prefix))
    )


def loggable(events: DataFrame) -> DataFrame:
    """Events of level Warning or above."""
    return events.where(level_rank(F.col("level")) >= LEVELS.index("Warning") + 1)


def newest(events: DataFrame, per: list[str], capacity: int = BUFFER_CAPACITY) -> DataFrame:
    """What a full buffer still holds when it is drained: the newest events, the oldest dropped.

    Spark keeps at most ``capacity`` rows of a group in every task before it shuffles.
    """
    latest = Window.partitionBy(*per).orderBy(F.col("ts").desc(), F.col("event_id").desc())
    return events.withColumn("_age", F.row_number().over(latest)).where(F.col("_age") <= capacity).drop("_age")


def _steps(seconds: np.ndarray, counts: np.ndarray, rules: AlertRules) -> tuple[np.ndarray, np.ndarray]:
    """For a batch opening at each second: first index after its window, and when it is sent."""
    window, full, _ = rules.waits
    total = np.cumsum(counts)
    if window == 0:
        return np.arange(1, len(seconds) + 1), seconds
    until = np.searchsorted(seconds, seconds + window)
    filled = np.searchsorted(total, total - counts + full)
    closes_full = filled < until
    sent = np.where(closes_full, seconds[np.minimum(filled, len(seconds) - 1)], seconds + window)
    return np.where(closes_full, filled + 1, until), sent


def _link_tables(key: tuple, cells: pd.DataFrame, rules: AlertRules) -> pd.DataFrame:
    """For every second a block may be entered at: the second the next block is entered at."""
    window, _, throttle = rules.waits
    cells = cells.sort_values("second")
    seconds = cells["second"].to_numpy()
    _, sent = _steps(seconds, cells["events"].to_numpy(), rules)
    owned = int(np.searchsorted(seconds, (key[1] + 1) * DAY))
    entry = key[1] * DAY + np.arange(window + throttle + 1)
    resume = entry.copy()
    position = np.searchsorted(seconds, entry)
    running = position < owned
    while running.any():
        resume[running] = sent[position[running]] + throttle
        position[running] = np.searchsorted(seconds, resume[running])
        running = position < owned
    return pd.DataFrame({"channel": [key[0]], "block": [key[1]], "exits": [resume.tolist()]})


def _link(days: pd.DataFrame, rules: AlertRules) -> pd.DataFrame:
    """Follow one channel through its days: the second each day may open its first batch."""
    window, _, throttle = rules.waits
    days = days.sort_values("block")
    resume, entries = None, []
    for block, exits in zip(days["block"], days["exits"]):
        start = block * DAY
        offset = 0 if resume is None else min(max(resume - start, 0), window + throttle)
        entries.append(start + offset)
        resume = int(exits[offset])
    return pd.DataFrame({"channel": days["channel"], "block": days["block"], "entry": entries})


_SEGMENTS = "channel string, second long, opened long, opened_rank long, sent long, from_rank long, to_rank long"


def _throttled_batches(key: tuple, cells: pd.DataFrame, rules: AlertRules) -> pd.DataFrame:
    """Seconds of one block that belong to a batch, and how many of their events it takes."""
    _, full, throttle = rules.waits
    cells = cells.sort_values("second")
    seconds, counts = cells["second"].to_numpy(), cells["events"].to_numpy()
    after, sent = _steps(seconds, counts, rules)
    capacity = 1 if rules.waits[0] == 0 else full
    owned = int(np.searchsorted(seconds, (key[1] + 1) * DAY))
    rows = []
    at = int(np.searchsorted(seconds, cells["entry"].iloc[0]))
    while at < owned:
        left = capacity
        for i in range(at, int(after[at])):
            take = int(min(left, counts[i]))
            rows.append((key[0], seconds[i], seconds[at], 0, sent[at], 0, take))
            left -= take
        at = int(np.searchsorted(seconds, sent[at] + throttle))
    return pd.DataFrame(rows, columns=[part.split()[0] for part in _SEGMENTS.split(", ")])


def _block_size(rules: AlertRules) -> int:
    return max(BLOCK_EVENTS, rules.waits[1])


def _cells_by_rank(counts: DataFrame, rules: AlertRules) -> DataFrame:
    """Seconds by blocks of events: ``channel, block, second, offset, events``.

    A block owns so many events of its channel and sees as many of the next block as a batch may take. A
    second that lies in several blocks is in each of them with the events it has there; ``offset`` of its
    events lie in earlier blocks.
    """
    size, full = _block_size(rules), rules.waits[1]
    parts = in_blocks(counts, ["channel", "second"])
    placed = running_total(parts, "channel", ["second"], "events", "first").drop("block")
    end = F.col("first") + F.col("events")
    lowest = F.greatest(F.lit(0), F.floor((F.col("first") - full) / size)).cast("long")
    placed = placed.withColumn("block", F.explode(F.sequence(lowest, F.floor((end - 1) / size).cast("long"))))
    start = F.greatest(F.col("first"), F.col("block") * size)
    stop = F.least(end, (F.col("block") + 1) * size + full)
    cells = placed.select("channel", "block", "second", (start - F.col("first")).alias("offset"), (stop - start).alias("events"))
    return cells.where("events > 0")


def _next_batch(cells: pd.DataFrame, rules: AlertRules) -> tuple[np.ndarray, np.ndarray]:
    """Second of every event of a block, and the event after the batch that would open there."""
    window, full, _ = rules.waits
    seconds = np.repeat(cells["second"].to_numpy(), cells["events"].to_numpy())
    at = np.arange(len(seconds))
    return seconds, (at + 1 if window == 0 else np.minimum(at + full, np.searchsorted(seconds, seconds + window)))


def _rank_links(key: tuple, cells: pd.DataFrame, rules: AlertRules, size: int) -> pd.DataFrame:
    """For every event a block may be entered at: the event the next block is entered at."""
    full = rules.waits[1]
    seconds, after = _next_batch(cells.sort_values("second"), rules)
    owned = min(len(seconds), size)
    # Events past the block stay where they are; each round doubles the batches that are skipped.
    reach = np.arange(max(len(seconds), size + full) + 1)
    reach[:owned] = after[:owned]
    while (reach[:owned] < owned).any():
        reach = reach[reach]
    return pd.DataFrame({"channel": [key[0]], "block": [key[1]], "exits": [np.clip(reach[:full] - size, 0, full - 1).tolist()]})


def _composed(key: tuple, links: pd.DataFrame) -> pd.DataFrame:
    """The table of neighbouring blocks taken as one."""
    tables = [np.asarray(exits) for exits in links.sort_values("block")["exits"]]
    through = tables[0]
    for table in tables[1:]:
        through = table[through]
    return pd.DataFrame({"channel": [key[0]], "block": [key[1]], "exits": [through.tolist()]})


def _followed(links: pd.DataFrame) -> pd.DataFrame:
    """Where each of neighbouring blocks is entered, given where the first is."""
    links = links.sort_values("block")
    at, entries = int(links["entry"].iloc[0]), []
    for exits in links["exits"]:
        entries.append(at)
        at = int(exits[at])
    return pd.DataFrame({"channel": links["channel"], "block": links["block"], "entry": entries})


def _rank_entries(links: DataFrame) -> DataFrame:
    """``channel, block, entry``: where the first batch of every block opens."""
    last = links.agg(F.max("block")).first()[0] or 0
    levels = [links]
    up = F.floor(F.col("block") / FAN).cast("long").alias("up")
    while last > 0:
        grouped = levels[-1].select("channel", up, "block", "exits").groupBy("channel", "up")
        levels.append(cut_lineage(grouped.applyInPandas(_composed, "channel string, block long, exits array<long>")))
        last //= FAN
    entries = levels.pop().select("channel", "block", F.lit(0).cast("long").alias("entry"))
    for lower in reversed(levels):
        above = entries.withColumnRenamed("block", "up")
        joined = lower.select("channel", up, "block", "exits").withColumnRenamed("channel", "_channel")
        met = F.col("channel").eqNullSafe(F.col("_channel")) & (joined["up"] == above["up"])
        joined = joined.join(above, met).select("channel", above["up"], "block", "exits", "entry")
        entries = joined.groupBy("channel", "up").applyInPandas(_followed, "channel string, block long, entry long")
    return entries


def _rank_batches(key: tuple, cells: pd.DataFrame, rules: AlertRules, size: int) -> pd.DataFrame:
    """Batches that open in one block: the next event opens the next batch."""
    window, full, _ = rules.waits
    cells = cells.sort_values("second")
    seconds, after = _next_batch(cells, rules)
    owned = min(len(seconds), size)
    starts, at = [], int(cells["entry"].iloc[0])
    while at < owned:
        starts.append(at)
        at = int(after[at])
    begin = np.array(starts, np.int64)
    # Pieces that lie in one batch and one second.
    edges = np.r_[0, np.cumsum(cells["events"].to_numpy())]
    cuts = np.unique(np.r_[begin, edges[(edges > begin[0]) & (edges < at)]]) if len(begin) else begin
    batch = np.searchsorted(begin, cuts, side="right") - 1
    cell = np.searchsorted(edges, cuts, side="right") - 1
    rank = cells["offset"].to_numpy()[cell] - edges[cell]
    opener = np.searchsorted(edges, begin, side="right") - 1
    taken = after[begin] - begin
    sent = np.where(taken >= (1 if window == 0 else full), seconds[after[begin] - 1], seconds[begin] + window)
    return pd.DataFrame(
        {
            "channel": np.full(len(cuts), key[0], dtype=object), "second": seconds[cuts], "opened": seconds[begin][batch],
            "opened_rank": (cells["offset"].to_numpy()[opener] + begin - edges[opener])[batch], "sent": sent[batch],
            "from_rank": rank + cuts, "to_rank": rank + np.r_[cuts[1:], at][: len(cuts)],
        }
    )


def _unthrottled_segments(counts: DataFrame, rules: AlertRules) -> DataFrame:
    size = _block_size(rules)
    cells = cut_lineage(_cells_by_rank(counts, rules))
    links = cells.groupBy("channel", "block").applyInPandas(
        lambda k, c: _rank_links(k, c, rules, size), "channel string, block long, exits array<long>"
    )
    entries = _rank_entries(cut_lineage(links)).withColumnRenamed("channel", "_channel")
    met = F.col("channel").eqNullSafe(F.col("_channel")) & (cells["block"] == entries["block"])
    entered = cells.join(entries, met).select("channel", cells["block"], "second", "offset", "events", "entry")
    return entered.groupBy("channel", "block").applyInPandas(lambda k, c: _rank_batches(k, c, rules, size), _SEGMENTS)


def counts_per_second(events: DataFrame) -> DataFrame:
    return events.groupBy("channel", seconds_of(F.col("ts")).alias("second")).agg(F.count("*").alias("events"))


def batch_segments(counts: DataFrame, rules: AlertRules = AlertRules()) -> DataFrame:
    """Which events of each channel and second go into which batch, as ranks within the second."""
    if not rules.enabled:
        return counts.sparkSession.createDataFrame([], _SEGMENTS)
    window, _, throttle = rules.waits
    if throttle == 0:
        return _unthrottled_segments(counts, rules)
    # A batch opened late in a day reaches into the next: its first seconds go to both days.
    day = F.floor(F.col("second") / DAY).cast("long")
    reach = F.floor((F.col("second") - window) / DAY).cast("long")
    cells = counts.withColumn("block", F.explode(F.sequence(reach, day)))
    days = cells.groupBy("channel", "block").applyInPandas(
        lambda k, c: _link_tables(k, c, rules), "channel string, block long, exits array<long>"
    )
    entries = days.groupBy("channel").applyInPandas(
        lambda k, d: _link(d, rules), "channel string, block long, entry long"
    )
    return (
        cells.join(entries, ["channel", "block"])
        .groupBy("channel", "block")
        .applyInPandas(lambda k, c: _throttled_batches(k, c, rules), _SEGMENTS)
    )


def batched_events(events: DataFrame, rules: AlertRules = AlertRules()) -> DataFrame:
    """Events that are sent, with the batch they go into; throttled events are gone.

    ``events`` holds ``channel, category, level, message, ts, event_id``.
    """
    timed = events.withColumn("second", seconds_of(F.col("ts")))
    segments = batch_segments(counts_per_second(events), rules)
    if rules.waits[2] > 0:
        # A batch takes the first events of a second and never more than it holds.
        first = Window.partitionBy("channel", "second").orderBy("ts", "event_id")
        ranked = timed.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= rules.waits[1])
    else:
        cell = F.concat_ws("\x00", F.col("channel"), F.col("second"))
        blocks = in_blocks(timed.withColumn("_cell", cell), ["_cell", "ts", "event_id"])
        ranked = (
            run_length(blocks, "_cell", ["ts", "event_id"], F.lit(False), "_rank").drop("_cell", "block")
        )
    return (
        ranked.join(segments, ["channel", "second"])
        .where((F.col("_rank") > F.col("from_rank")) & (F.col("_rank") <= F.col("to_rank")))
        .drop("_rank", "from_rank", "to_rank", "second")
    )


_BATCH = ["channel", "opened", "opened_rank"]


def batch_summary(batched: DataFrame) -> DataFrame:
    """One row per batch: events, categories, first and last time, when it was sent."""
    return batched.groupBy(*_BATCH).agg(
        F.count("*").alias("events"),
        F.count_distinct("category").alias("categories"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.max("sent").alias("sent"),
    )


def category_counts(batched: DataFrame) -> DataFrame:
    """Events per category of a batch, most first; equal counts by first appearance."""
    counted = batched.groupBy(*_BATCH, "category").agg(
        F.count("*").alias("events"), F.min(F.struct("ts", "event_id")).alias("_seen")
    )
    # A batch is bounded by the rules, so its categories are as well.
    order = Window.partitionBy(*_BATCH).orderBy(F.col("events").desc(), F.col("_seen"))
    return counted.withColumn("position", F.row_number().over(order)).drop("_seen")
