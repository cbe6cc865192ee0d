"""Alert batches without throttle, in blocks of events, against the chain followed event by event."""

from __future__ import annotations

import numpy as np
import pytest

from folioflow.operators import alerts
from folioflow.operators.alerts import AlertRules, batch_segments

SCHEMA = "channel string, second long, events long"


def plain(counts: list[tuple[str, int, int]], rules: AlertRules) -> list[tuple]:
    window, full, _ = rules.waits
    full = 1 if window == 0 else full
    out = []
    for channel in {c for c, _, _ in counts}:
        events = [(s, r) for c, s, n in sorted(counts, key=lambda x: x[1]) if c == channel for r in range(n)]
        at = 0
        while at < len(events):
            opened, rank = events[at]
            taken = []
            while at < len(events) and len(taken) < full and (events[at][0] < opened + window or not taken):
                taken.append(events[at])
                at += 1
            sent = taken[-1][0] if len(taken) == full else opened + window
            for second in sorted({s for s, _ in taken}):
                ranks = [r for s, r in taken if s == second]
                out.append((channel, second, opened, rank, sent, ranks[0], ranks[-1] + 1))
    return sorted(out)


@pytest.mark.parametrize("block,fan", [(4, 2), (50_000, 64)])
@pytest.mark.parametrize("rules", [AlertRules(60, 4, 0), AlertRules(5, 3, 0), AlertRules(0, 9, 0)])
def test_blocks_equal_the_chain(spark, monkeypatch, block, fan, rules):
    monkeypatch.setattr(alerts, "BLOCK_EVENTS", block)
    monkeypatch.setattr(alerts, "FAN", fan)
    draw = np.random.default_rng(7)
    counts = [("hot", int(s), int(draw.integers(1, 9))) for s in np.cumsum(draw.integers(1, 30, size=24))]
    counts += [("one", 5, 1), ("burst", 9, 70), ("pair", 1, 2), ("pair", 61, 2)]
    found = batch_segments(spark.createDataFrame(counts, SCHEMA), rules)
    assert sorted(tuple(r) for r in found.collect()) == plain(counts, rules)


def test_more_groups_than_channels(spark, monkeypatch):
    monkeypatch.setattr(alerts, "BLOCK_EVENTS", 10)
    counts = spark.createDataFrame([("hot", s, 3) for s in range(100)], SCHEMA)
    cells = alerts._cells_by_rank(counts, AlertRules(60, 5, 0))
    sizes = {r["block"]: r["n"] for r in cells.groupBy("block").agg({"events": "sum"}).toDF("block", "n").collect()}
    assert len(sizes) == 30 and max(sizes.values()) == 15  # ten of its own, five of the next


def test_no_events(spark):
    assert batch_segments(spark.createDataFrame([], SCHEMA), AlertRules(60, 5, 0)).count() == 0
