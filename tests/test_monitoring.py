"""The error report: what is logged and mailed, repeated runs, retention."""

from __future__ import annotations

import datetime as dt

from folioflow.operators.alerts import AlertRules
from folioflow.plans.monitoring import ErrorReport


def test_a_run_logs_mails_and_expires(spark, tmp_path):
    day = dt.datetime(2031, 5, 20, 8)
    rows = [("ops", "disk", "Error", f"e{k}", day + dt.timedelta(seconds=k), k) for k in range(5)]
    rows += [("ops", "net", "Critical", "n", day + dt.timedelta(seconds=2), 10), ("ops", "net", "Warning", "w", day, 11)]
    rows += [("ops", "mail.own", "Error", "own", day, 12), ("ops", "net", "Information", "i", day, 13)]
    rows += [("ops", "old", "Error", "o", day - dt.timedelta(days=9), 14)]
    events = spark.createDataFrame(
        rows, "channel string, category string, level string, message string, ts timestamp_ntz, event_id long"
    )
    report = ErrorReport(spark, f"{tmp_path}/log", f"{tmp_path}/out", "mail.", AlertRules(60, 50, 120))
    assert tuple(report.run(events, "a", day.date()).first()) == (9, 7, 2)
    assert tuple(report.run(events, "a", day.date()).first()) == (9, 7, 2)
    assert report.logged().count() == 9 and report.mails().count() == 2
    mail = report.mails().orderBy("opened").collect()[-1]
    assert [(c["category"], c["events"]) for c in mail["counted"]] == [("disk", 5), ("net", 1)]

    kept = ErrorReport(spark, report.log, report.outbox, "mail.", keep_days=5)
    assert tuple(kept.run(events.limit(0), "b", day.date()).first()) == (0, 0, 0)
    assert {r["day"] for r in kept.logged().collect()} == {day.date()}
