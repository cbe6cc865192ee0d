"""Operators with state or skew, against plain Python on small random data."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from folioflow.operators import alerts, listing
from folioflow.operators.alerts import AlertRules
from folioflow.operators.attempts import number_attempts
from folioflow.operators.guides import evaluate, supersede_within
from folioflow.operators.parameters import invoice_folder
from folioflow.operators.reconcile import mark_registered, registered_keys, run_counters
from folioflow.streaming import stateful

START = dt.datetime(2026, 4, 8)


def make_events(spark, seed, channels=3, n=400, span=4 * 86400, burst=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = rng.randrange(span) if i >= burst else span // 2 + rng.randrange(5)
        ts = START + dt.timedelta(seconds=at, microseconds=rng.randrange(10**6))
        rows.append((f"c{rng.randrange(channels)}", rng.choice("abc"), ts, i))
    return rows, spark.createDataFrame(rows, "channel string, category string, ts timestamp_ntz, event_id long")


def expected_batches(rows, rules):
    """Event by event, the way the mailer reads its queue, on a clock of whole seconds."""
    window, full, throttle = rules.waits
    found = []
    for channel in sorted({r[0] for r in rows}):
        queue = sorted((r[2], r[3], r[1]) for r in rows if r[0] == channel)
        last, i = None, 0
        while i < len(queue):
            now = int((queue[i][0] - dt.datetime(1970, 1, 1)).total_seconds())
            if throttle and last is not None and now - last < throttle:
                i += 1
                continue
            batch, last = [queue[i]], now
            i += 1
            if window:
                while len(batch) < full:
                    if i == len(queue) or int((queue[i][0] - dt.datetime(1970, 1, 1)).total_seconds()) >= now + window:
                        last = now + window
                        break
                    batch.append(queue[i])
                    last = int((queue[i][0] - dt.datetime(1970, 1, 1)).total_seconds())
                    i += 1
            found.append((channel, now, last, tuple(e[1] for e in batch)))
    return sorted(found)


RULES = [
    AlertRules(), AlertRules(window=3600, max_batch=3, throttle=7200), AlertRules(window=0, throttle=120),
    AlertRules(window=3600, max_batch=4, throttle=0), AlertRules(window=0, throttle=0),
    AlertRules(window=90000, max_batch=50, throttle=100000), AlertRules(window=1, max_batch=3, throttle=0),
]


@pytest.mark.parametrize("rules", RULES, ids=str)
def test_alert_batches(spark, rules):
    rows, events = make_events(spark, 7, burst=150)
    batched = alerts.batched_events(events, rules)
    found = batched.groupBy("channel", "opened", "opened_rank", "sent").agg(
        F.sort_array(F.collect_list(F.struct("ts", "event_id"))).alias("e")
    )
    got = sorted((r["channel"], r["opened"], r["sent"], tuple(e["event_id"] for e in r["e"])) for r in found.collect())
    assert got == expected_batches(rows, rules)


def test_disabled_alerts_send_nothing(spark):
    _, events = make_events(spark, 1, n=20)
    assert alerts.batched_events(events, AlertRules(enabled=False)).count() == 0


@pytest.mark.parametrize("rules", [RULES[1], RULES[3]], ids=str)
def test_alert_stream_equals_batch(spark, rules, tmp_path):
    rows, events = make_events(spark, 3, channels=2, n=200)
    # One event far ahead in a channel of its own moves the watermark past every open batch.
    last = spark.createDataFrame([("z", "a", START + dt.timedelta(days=400), 10**6)], events.schema)
    source = tmp_path / "in"
    for i in range(3):
        part = events.orderBy("ts", "event_id").offset(i * 70).limit(70 if i < 2 else 1000)
        (part if i < 2 else part.unionByName(last)).coalesce(1).write.mode("append").parquet(str(source))
    with stateful.rocksdb_state(spark):
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        query = (
            stateful.batched_events(stream, rules).writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
        )
        query.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).where("channel <> 'z'")
    found = found.groupBy("channel", "opened", "opened_rank", "sent").agg(
        F.sort_array(F.collect_list(F.struct("ts", "event_id"))).alias("e")
    )
    got = sorted((r["channel"], r["opened"], r["sent"], tuple(e["event_id"] for e in r["e"])) for r in found.collect())
    assert got == expected_batches(rows, rules)


def test_alert_stream_keeps_late_events_and_whole_batches(spark, tmp_path):
    """A batch of more than 500 comes out whole, and an event far behind the watermark is not lost."""
    schema = "channel string, category string, ts timestamp_ntz, event_id long"
    parts = [
        [("c", "a", START + dt.timedelta(milliseconds=i), i) for i in range(700)],
        [("c", "a", START + dt.timedelta(seconds=900), 700)],
        [("c", "late", START + dt.timedelta(seconds=300), 701), ("z", "a", START + dt.timedelta(days=9), 702)],
        [("z", "a", START + dt.timedelta(days=20), 703)],
    ]
    source = tmp_path / "in"
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(source))
    with stateful.rocksdb_state(spark):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        query = (
            stateful.batched_events(stream, AlertRules(window=2000, max_batch=600, throttle=0)).writeStream
            .format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
            .start(str(tmp_path / "out"))
        )
        query.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).where("channel = 'c'").groupBy("opened", "opened_rank").count()
    assert sorted(r["count"] for r in found.collect()) == [102, 600]


def test_summary_counts_categories_by_first_appearance(spark):
    rows = [("c", cat, START + dt.timedelta(seconds=i), i) for i, cat in enumerate("baab")] + [
        ("c", "z", START + dt.timedelta(seconds=9), 9)
    ]
    events = spark.createDataFrame(rows, "channel string, category string, ts timestamp_ntz, event_id long")
    counts = alerts.category_counts(alerts.batched_events(events)).orderBy("position").collect()
    assert [(r["category"], r["events"]) for r in counts] == [("b", 2), ("a", 2), ("z", 1)]


def test_levels_and_own_category(spark):
    rows = [("Intake", level) for level in ("Information", "Warning", "Error", "Critical")] + [("Alerts.Mail.Smtp", "Error")]
    events = spark.createDataFrame(rows, "category string, level string")
    assert sorted(r["level"] for r in alerts.alertable(events, "Alerts.Mail").collect()) == ["Critical", "Error"]
    assert alerts.loggable(events).count() == 4


def test_buffer_drops_the_oldest(spark):
    rows = [("c", "a", START + dt.timedelta(seconds=i), i) for i in range(520)]
    events = spark.createDataFrame(rows, "channel string, category string, ts timestamp_ntz, event_id long")
    kept = {r["event_id"] for r in alerts.newest(events, ["channel"]).collect()}
    assert kept == set(range(20, 520))


def expected_attempts(rows, limit):
    failures, found = {}, []
    for path, ts, i, success in sorted(rows, key=lambda r: (r[1], r[2])):
        key = path.lower()
        if success:
            failures[key] = 0
            continue
        failures[key] = failures.get(key, 0) % limit + 1
        found.append((i, failures[key], failures[key] == limit))
    return sorted(found)


def attempt_rows(seed, n=600):
    rng = random.Random(seed)
    # One path holds about half of all attempts.
    return [
        (rng.choice(["/A.xml", "/a.xml", "/a.XML", "/b.xml", "/c.xml"]), START + dt.timedelta(seconds=rng.randrange(300)), i,
         rng.random() < 0.1)
        for i in range(n)
    ]


_OUTCOME = "path string, ts timestamp_ntz, attempt_id long, success boolean, error string"


@pytest.mark.parametrize("limit", [0, 1, 3])
def test_attempts_of_a_hot_path(spark, limit):
    rows = attempt_rows(limit)
    df = spark.createDataFrame([(*r, "e") for r in rows], _OUTCOME).repartition(5)
    got = number_attempts(df, limit).select("attempt_id", "attempts", "quarantined").collect()
    assert sorted(map(tuple, got)) == expected_attempts(rows, max(1, limit))


def test_attempt_stream_equals_batch(spark, tmp_path):
    rows = sorted(attempt_rows(5, 200), key=lambda r: (r[1], r[2]))
    source = tmp_path / "in"
    for i in range(0, 200, 50):
        spark.createDataFrame([(*r, "e") for r in rows[i:i + 50]], _OUTCOME).coalesce(1).write.mode("append").parquet(str(source))
    with stateful.rocksdb_state(spark):
        stream = spark.readStream.schema(_OUTCOME).option("maxFilesPerTrigger", 1).parquet(str(source))
        stateful.number_attempts(stream).writeStream.format("parquet").option(
            "checkpointLocation", str(tmp_path / "state")
        ).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("attempt_id", "attempts", "quarantined").collect()
    assert sorted(map(tuple, got)) == expected_attempts(rows, 3)


def listed(spark, rows):
    return spark.createDataFrame(rows, "path string, modificationTime timestamp_ntz, creation_time timestamp_ntz, length long")


def test_oldest_first_with_ties_unknown_times_and_limit(spark):
    hour = dt.timedelta(hours=1)
    rows = [
        ("d", START, START, 1), ("c", START, None, 1), ("b", START + hour, START - hour, 1), ("z", None, None, 1),
        ("a", START + 5 * hour, START + 4 * hour, 1),
    ]
    df = listed(spark, rows)
    for n in range(1, 7):
        got = [r["path"] for r in listing.oldest_first(df, n).collect()]
        assert got == ["b", "c", "d", "a", "z"][:n]
    assert [r["path"] for r in listing.oldest_first(df, None).collect()] == ["b", "c", "d", "a", "z"]


def test_backlog_bounds(spark):
    rows = [(f"f{i}", START - dt.timedelta(days=i), None, 1) for i in range(10)]
    df = listed(spark, rows)
    week = dt.timedelta(days=7)
    assert sorted(r["path"] for r in listing.backlog(df, START, week).collect()) == [f"f{i}" for i in range(8)]
    assert [r["path"] for r in listing.backlog(df, START, week, 2).collect()] == ["f7", "f6"]
    assert listing.backlog(df, START, dt.timedelta(0), 0).count() == 10


def test_limit_before_registered_check_can_starve(spark):
    rows = [(f"/p/{i}", START + dt.timedelta(hours=i), None, 1) for i in range(4)]
    df = listed(spark, rows)
    keys = registered_keys(spark.createDataFrame([("/P/0",), ("/p/1",)], "k string"), "k")
    marked = mark_registered(listing.oldest_first(df, 2), F.col("path"), keys)
    assert tuple(run_counters(marked, "path").first()) == (2, 2, 0, 0)


def test_many_keys_find_the_three_registered(spark):
    names = [f"candidate-{i}.xml" for i in range(1002)]
    names[123], names[500], names[1001] = "exists-1.xml", "EXISTS-2.xml", "exists-3.xml"
    candidates = spark.createDataFrame([(n,) for n in names], "path string")
    stored = spark.createDataFrame([(f"exists-{i}.xml",) for i in (1, 2, 3)], "NameFile string")
    marked = mark_registered(candidates, F.col("path"), registered_keys(stored, "NameFile"))
    assert marked.where("registered").count() == 3


def test_last_of_a_hot_delivery(spark):
    rows = [(f"/p/{i:04d}", "" if i % 3 else f"D{i}", START + dt.timedelta(seconds=i % 50)) for i in range(900)]
    df = spark.createDataFrame(rows, "path string, delivery string, effective_time timestamp_ntz")
    current = {r["path"] for r in supersede_within(df).where("is_current").collect()}
    best = {}
    for path, delivery, ts in rows:
        best[delivery] = max(best.get(delivery, (ts, path)), (ts, path))
    assert current == {path for _, path in best.values()}


def test_invoice_folder(spark):
    parameters = spark.createDataFrame(
        [("IDOC", "I2CARPETA", "/b/in/"), ("idoc", "i2carpeta", "/a/in//"), ("IDOC", "OTHER", "/0")],
        "tabla string, parametro string, valor string",
    )
    assert invoice_folder(parameters, "/configured") == "/a/in"
    assert invoice_folder(parameters.limit(0), "/configured") is None
    assert invoice_folder(None, "/configured/") == "/configured"
    assert invoice_folder(None, " ") is None


def test_pdfs_without_a_guide_name_are_not_looked_for_by_one_key(spark):
    """All of them spell the same name: as a join key it would bring them together."""
    asked = []

    def known(candidates):
        asked.append(sorted(r["key"] or "" for r in candidates.collect()))
        return spark.createDataFrame([("gr-0t001-0000001",), ("gr-0t001-0000009",), ("gr-0-",)], "registered_key string")

    def pdf(n):
        return (f"/in/20100000001-09-T001-0000000{n}.pdf", dt.datetime(2026, 4, n), 5)

    pdfs = spark.createDataFrame([pdf(n) for n in range(1, 7)], "path string, effective_time timestamp_ntz, length long")
    texts = {3: "A;Serie;1; \nA;Correlativo;1;1", 4: "A;Serie;1;T001\nA;Correlativo;1;0000009", 5: "A;Serie;1;T001\nA;Correlativo;1;0000005"}
    records = spark.createDataFrame([(f"/in/20100000001-T001-000000{n}.txt", t) for n, t in texts.items()], "path string, value string")
    judged = {r["path"][-5]: r["reason"] for r in evaluate(pdfs, records, known).collect()}
    assert judged == {
        "1": "already_registered", "2": "record_missing", "3": "serie_or_correlative_missing", "4": "already_registered",
        "5": "bad_motive", "6": "record_missing",
    }
    assert asked[1] == ["", "", "", "", "gr-0t001-0000005", "gr-0t001-0000009"]
