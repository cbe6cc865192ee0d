"""Jobs on real files: registration, supersede, reconciliation, streams. Running twice changes nothing."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from folioflow.operators.attempts import in_circulation, number_attempts, quarantine_rows
from folioflow.operators.invoices import parse_documents
from folioflow.functions.names import relative_to
from folioflow.plans.jobs import (
    DailyRun, companion_records, folder_root, quarantine, register_guides, register_invoices,
)
from folioflow.sinks.files import expire_log, log_entries, write_log, write_quarantine
from folioflow.sinks.registry import GuideRegistry, InvoiceRegistry
from folioflow.sources.landing import PDF_FILES, XML_FILES, list_files, read_documents
from folioflow.streaming import ingest
from tests.samples import Landing, invoice, line, record

NOW = dt.datetime(2026, 4, 8, 9, 0)


@pytest.fixture
def landing(tmp_path):
    return Landing(tmp_path)


@pytest.fixture
def guides(spark, tmp_path):
    return GuideRegistry(spark, str(tmp_path / "guides"))


@pytest.fixture
def invoices(spark, tmp_path):
    return InvoiceRegistry(spark, str(tmp_path / "invoices"))


def register(spark, guides, landing, batch_id="1", as_of=NOW):
    pdfs = list_files(spark, landing.folders.pdf, PDF_FILES)
    records = companion_records(spark, landing.folders.txt, pdfs)
    judged = register_guides(guides, pdfs, records, as_of, batch_id, landing.folders)
    return {row["path"].rsplit("/", 1)[1]: (row["status"], row["reason"]) for row in judged.collect()}


def table(guides):
    return {row["greName"]: row for row in guides.read().collect()}


def copied(landing):
    root = landing.root / "routed"
    return {(f.parent.name, f.name): f.read_bytes() for f in root.rglob("*") if f.is_file() and f.suffix != ".crc"}


def test_happy_path(spark, guides, landing):
    landing.guide()
    assert register(spark, guides, landing) == {"20990011224-09-T001-00204617.pdf": ("accepted", None)}
    (row,) = guides.read().collect()
    assert (row["greName"], row["delivery"], row["city"], row["stateCode"]) == ("GR-0T001-0204617", "8300456789", 15, "LI")
    assert (row["motivoTraslado"], row["Auditoria_Deleted"]) == (3, False)
    assert row["fechaInicioTraslado"] == dt.datetime(2026, 4, 7)
    assert copied(landing) == {("dirEcommerce", "20990011224-09-T001-00204617.pdf"): b"%PDF T001 0204617"}


def test_routes_and_states(spark, guides, landing):
    wanted = {}
    for number, fields, route, state in (
        ("0000001", {"motive": "1"}, "dirPDFs", "LI"),
        ("0000002", {"motive": "3", "serie": "T004"}, "dirHpmps", "LI"),
        ("0000003", {"motive": "99", "serie": "T004", "postal": "990101"}, "dirPDFs", "99"),
        ("0000004", {"motive": "03", "postal": "0101"}, "dirEcommerce", "AM"),
    ):
        path = landing.guide(number, **fields)
        wanted[number] = (path.rsplit("/", 1)[1], route, state)
    register(spark, guides, landing)
    routes = {name: route for route, name in copied(landing)}
    states = {name[-7:]: row["stateCode"] for name, row in table(guides).items()}
    assert {n: (name, routes[name], states[n]) for n, (name, _, _) in wanted.items()} == wanted


def test_rejected_guides_leave_nothing(spark, guides, landing):
    wanted = {}
    for number, fields, reason in (
        ("0000001", {"motive": "X"}, "bad_motive"),
        ("0000002", {"postal": "XX"}, "bad_postal_code"),
        ("0000003", {"postal": "1"}, "bad_postal_code"),
        ("0000004", {"date": "soon"}, "bad_transfer_date"),
    ):
        path = landing.guide(number, **fields)
        wanted[path.rsplit("/", 1)[1]] = ("skipped", reason)
    assert register(spark, guides, landing) == wanted
    assert guides.read().count() == 0


def test_record_missing_empty_or_blank_and_bad_names(spark, guides, landing):
    landing.put("pdf", "20990011224-09-T001-00000001.pdf", "x")
    landing.put("pdf", "20990011224-09-T001-00000002.PDF", "x")
    landing.put("txt", "20990011224-T001-0000002.txt", "")
    landing.put("pdf", "20990011224-09-T001-00000003.pdf", "x")
    landing.put("txt", "20990011224-t001-0000003.TXT", "A;Serie;1; \nA;Correlativo;1;1")
    landing.put("pdf", "short-name.pdf", "x")
    landing.put("pdf", "20990011224-09-T001-00000004.pdf", "")
    assert register(spark, guides, landing) == {
        "20990011224-09-T001-00000001.pdf": ("skipped", "record_missing"),
        "20990011224-09-T001-00000002.PDF": ("skipped", "record_missing"),
        "20990011224-09-T001-00000003.pdf": ("skipped", "serie_or_correlative_missing"),
        "short-name.pdf": ("failed", "bad_file_name"),
    }


def test_second_run_changes_nothing(spark, guides, landing):
    landing.guide()
    register(spark, guides, landing)
    before = guides.read().collect()
    assert list(register(spark, guides, landing, "2").values()) == [("skipped", "already_registered")]
    register(spark, guides, landing, "1")
    assert guides.read().collect() == before


def test_same_guide_twice_in_a_batch_is_registered_once(spark, guides, landing):
    landing.guide()
    landing.put("pdf", "20990011224-09-T001-00204617-copy.pdf", "copy")
    register(spark, guides, landing)
    assert guides.read().count() == 1


def test_last_guide_of_a_delivery_stays_active(spark, guides, landing):
    landing.guide("0000001", delivery="D1")
    landing.guide("0000002", delivery="D2")
    register(spark, guides, landing)
    later = NOW + dt.timedelta(days=1)
    landing.guide("0000003", delivery="D1")
    landing.guide("0000004", delivery="D1")
    register(spark, guides, landing, "2", later)
    rows = table(guides)
    assert {name: row["Auditoria_Deleted"] for name, row in rows.items()} == {
        "GR-0T001-0000001": True, "GR-0T001-0000002": False, "GR-0T001-0000003": True, "GR-0T001-0000004": False,
    }
    assert rows["GR-0T001-0000001"]["Auditoria_DeletedAt"] == later
    assert rows["GR-0T001-0000001"]["Auditoria_CreatedAt"] == NOW


def test_empty_delivery_supersedes_like_any_other(spark, guides, landing):
    landing.guide("0000001", delivery="")
    register(spark, guides, landing)
    landing.guide("0000002", delivery="")
    register(spark, guides, landing, "2")
    assert {n: r["Auditoria_Deleted"] for n, r in table(guides).items()} == {
        "GR-0T001-0000001": True, "GR-0T001-0000002": False,
    }


def test_voided_guide_still_blocks_its_name(spark, guides, landing):
    landing.guide("0000001", delivery="D")
    register(spark, guides, landing)
    landing.guide("0000002", delivery="D")
    register(spark, guides, landing, "2")
    found = register(spark, guides, landing, "3")
    assert set(found.values()) == {("skipped", "already_registered")}


def test_snapshot_keeps_the_table_and_later_batches_count(spark, guides, landing):
    landing.guide("0000001", delivery="D")
    register(spark, guides, landing)
    landing.guide("0000002", delivery="D")
    register(spark, guides, landing, "2")
    before = table(guides)
    guides.snapshot("s1", NOW)
    assert table(guides) == before
    landing.guide("0000003", delivery="D")
    register(spark, guides, landing, "3")
    assert [r["greName"] for r in guides.read().where(~F.col("Auditoria_Deleted")).collect()] == ["GR-0T001-0000003"]


def test_uncommitted_batch_is_not_seen(spark, guides, invoices, landing):
    landing.guide()
    register(spark, guides, landing)
    guides.write("guides", "dead", guides.read_rows())
    invoices.write("lines", "dead", spark.createDataFrame([("a", "b", "c", "d", "e")], invoices.tables["lines"]))
    assert guides.read().count() == 1
    assert invoices.lines().count() == 0


def test_copy_that_fails_registers_nothing(spark, guides, landing, monkeypatch):
    landing.guide()
    monkeypatch.setattr("folioflow.plans.jobs.copy_routed", lambda s, accepted, *a: accepted.limit(0))
    register(spark, guides, landing)
    assert guides.read().count() == 0


def daily(spark, landing, guides, invoices, **options):
    run = DailyRun(spark, landing.folders, guides, invoices)
    summary = run.run(options.pop("as_of", NOW), **options)
    return {r["pipeline"]: (r["pending"], r["processed"], r["failed"]) for r in summary.collect()}


def test_daily_run(spark, landing, guides, invoices):
    landing.guide("0000001")
    landing.put("pdf", "odd.pdf", "x")
    landing.put("xml", "a.xml", invoice())
    landing.put("xml", "b.XML", invoice(lines=[line(part="ABC")]))
    landing.put("xml", "c.txt", "not listed")
    assert daily(spark, landing, guides, invoices) == {"guide": (2, 1, 1), "invoice": (2, 1, 1)}
    assert [r["NameFile"] for r in invoices.headers().collect()] == ["/a.xml"]
    assert invoices.lines().count() == 1
    later = NOW + dt.timedelta(days=1)
    assert daily(spark, landing, guides, invoices, as_of=later) == {"guide": (1, 0, 1), "invoice": (1, 0, 1)}
    assert (guides.read().count(), invoices.headers().count()) == (1, 1)


def test_daily_run_only_today_and_limit(spark, landing, guides, invoices):
    today = int(dt.datetime(2026, 4, 8, tzinfo=dt.timezone.utc).timestamp())
    for name, when in (("y", today - 15 * 3600), ("a", today + 8 * 3600), ("b", today + 10 * 3600), ("c", today + 12 * 3600)):
        landing.put("xml", f"{name}.xml", invoice(), when)
    daily(spark, landing, guides, invoices, only_today=True, max_files=2, pipelines=("invoice",))
    assert sorted(r["NameFile"] for r in invoices.headers().collect()) == ["/a.xml", "/b.xml"]
    # The limit applies before registered files are left out: the two oldest are y and a.
    daily(spark, landing, guides, invoices, as_of=NOW.replace(hour=10), max_files=2, pipelines=("invoice",))
    assert sorted(r["NameFile"] for r in invoices.headers().collect()) == ["/a.xml", "/b.xml", "/y.xml"]


def test_daily_run_isolates_pipelines_and_does_not_overlap(spark, landing, guides, invoices, monkeypatch):
    landing.put("xml", "a.xml", invoice())
    run = DailyRun(spark, landing.folders, guides, invoices)

    def broken(*_):
        raise RuntimeError("share is gone")

    monkeypatch.setattr(run, "_guides", broken)
    rows = {r["pipeline"]: r for r in run.run(NOW).collect()}
    assert rows["guide"]["error"] == "share is gone"
    assert rows["invoice"]["processed"] == 1
    with run._active:
        assert run.run(NOW) is None


def test_invoice_stream_equals_batch_and_is_idempotent(spark, landing, invoices, tmp_path):
    for i in range(12):
        landing.put("xml", f"{i}.xml", invoice(SAPBillingDocumentNumber=str(i)))
    landing.put("xml", "bad.xml", "<x")
    for attempt in range(2):
        ingest.invoices_from_files(
            invoices, landing.folders, str(tmp_path / "state"), lambda: NOW, max_files=5
        ).awaitTermination()
        assert invoices.headers().count() == 12, attempt
    landing.put("xml", "12.xml", invoice())
    ingest.invoices_from_files(invoices, landing.folders, str(tmp_path / "state"), lambda: NOW).awaitTermination()
    assert (invoices.headers().count(), invoices.lines().count()) == (13, 13)


def test_late_record_triggers_its_pdf(spark, landing, guides, tmp_path):
    landing.put("pdf", "20990011224-09-T001-00204617.pdf", "early")
    ingest.guides_from_pdfs(guides, landing.folders, str(tmp_path / "p"), lambda: NOW).awaitTermination()
    assert guides.read().count() == 0
    landing.guide()
    ingest.guides_from_records(guides, landing.folders, str(tmp_path / "t"), lambda: NOW).awaitTermination()
    assert [r["greName"] for r in guides.read().collect()] == ["GR-0T001-0204617"]


def test_quarantine_table(spark, tmp_path):
    rows = [("/in/A.xml", 1), ("/in/a.xml", 2), ("/in/a.xml", 3), ("/other/a.xml", 4), ("/in/b.xml", 5)]
    df = spark.createDataFrame(
        [(p, dt.datetime(2026, 4, 8, 1, 2, i), i, False, "boom") for p, i in rows],
        "path string, ts timestamp_ntz, attempt_id long, success boolean, error string",
    )
    numbered = number_attempts(df, 1)
    write_quarantine(quarantine_rows(numbered), str(tmp_path / "q"), "1")
    stored = spark.read.parquet(str(tmp_path / "q" / "batch=1")).orderBy("attempt_id").collect()
    assert [r["stored_as"] for r in stored] == ["A.xml", "a.010202000.xml", "a.010203000.xml", "a.010204000.xml", "b.xml"]
    assert quarantine_rows(numbered, enabled=False).count() == 0


def test_files_that_keep_failing_end_in_quarantine(spark, landing, invoices, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    landing.put("xml", "good.xml", invoice())
    landing.put("xml", "bad.xml", "<x")
    root = folder_root(spark, landing.folders.xml)
    for day in range(4):
        listed = list_files(spark, landing.folders.xml, XML_FILES)
        documents = read_documents(spark, landing.folders.xml, XML_FILES, listed)
        documents = documents.withColumn("name_file", relative_to(F.col("path"), root))
        register_invoices(invoices, documents, NOW + dt.timedelta(days=day), str(day), log)
    (row,) = quarantine(spark, log, store, "q1").collect()
    assert (row["stored_as"], row["attempts"], row["day"]) == ("bad.xml", 3, dt.date(2026, 4, 10))
    assert spark.read.parquet(f"{store}/batch=q1").count() == 1
    # Another run stores nothing twice; the same run may be repeated.
    assert quarantine(spark, log, store, "q2").count() == 0
    assert quarantine(spark, log, store, "q1").count() == 1
    assert spark.read.parquet(store).count() == 1


def test_quarantined_file_is_out_of_circulation_until_it_changes(spark, landing, guides, invoices, tmp_path):
    log, dead = str(tmp_path / "log"), str(tmp_path / "dead")
    landing.put("xml", "good.xml", invoice())
    landing.put("xml", "bad.xml", "<x")

    def day(n: int) -> tuple[int, int]:
        run = DailyRun(spark, landing.folders, guides, invoices, log, dead, max_attempts=2)
        (row,) = run.run(NOW + dt.timedelta(days=n), pipelines=("invoice",)).collect()
        assert row["error"] is None
        return row["pending"], row["failed"]

    assert [day(n) for n in range(3)] == [(2, 1), (1, 1), (0, 0)]
    stored = spark.read.parquet(f"{dead}/invoice")
    assert [(r["stored_as"], r["attempts"], r["length"]) for r in stored.collect()] == [("bad.xml", 2, 2)]
    # Same text, later write time: a new version with attempts of its own.
    landing.put("xml", "bad.xml", "<x")
    assert [day(n) for n in range(3, 6)] == [(1, 1), (1, 1), (0, 0)]
    landing.put("xml", "bad.xml", invoice(SAPBillingDocumentNumber="1"))
    assert day(6) == (1, 0)
    assert invoices.headers().count() == 2


def test_circulation_compares_versions(spark):
    schema = "path string, modificationTime timestamp_ntz, length long"
    now, later = NOW, NOW + dt.timedelta(seconds=1)
    listed = spark.createDataFrame([("/a", now, 1), ("/B", now, 1), ("/c", later, 1), ("/d", now, 2), ("/e", now, 1), (None, now, 1)], schema)
    dead = spark.createDataFrame([("/a", now, 1), ("/a", now, 1), ("/b", now, 1), ("/c", now, 1), ("/d", now, 1), ("/e", None, None), (None, now, 1)], schema)
    assert {r["path"] for r in in_circulation(listed, dead).collect()} == {"/c", "/d", "/e", None}
    assert in_circulation(listed, dead.limit(0)).count() == 6 and in_circulation(listed.limit(0), dead).count() == 0


def test_quarantine_needs_the_attempt_log(spark, landing, guides, invoices):
    with pytest.raises(ValueError, match="attempt log"):
        DailyRun(spark, landing.folders, guides, invoices, dead_letters="/x")


def test_records_whose_names_differ_in_case_give_one_row(spark, landing, tmp_path):
    landing.guide(number="0000007")
    name = "20990011224-T001-0000007"
    landing.put("txt", f"{name}.TXT", record(number="0000007"))
    pdfs = list_files(spark, landing.folders.pdf, PDF_FILES)
    assert companion_records(spark, landing.folders.txt, pdfs).count() == 1


def test_null_invoice_is_malformed(spark):
    rows = spark.createDataFrame([("a", None), ("b", ""), ("c", invoice())], "path string, value string")
    errors = {r["path"]: r["xml_error"] for r in parse_documents(rows).collect()}
    assert errors["a"] and errors["b"] and errors["c"] is None


def test_log_retention(spark, tmp_path):
    days = [dt.datetime(2026, 4, d, 12) for d in (1, 2, 8)]
    events = spark.createDataFrame(
        [("c", level, "m", day, i) for i, day in enumerate(days) for level in ("Warning", "Information")],
        "category string, level string, message string, ts timestamp_ntz, event_id long",
    )
    target = str(tmp_path / "log")
    write_log(log_entries(events, "  "), target, "b1")
    write_log(log_entries(events, "  "), target, "b1")
    assert expire_log(spark, target, dt.date(2026, 4, 8), 0) == []
    assert expire_log(spark, target, dt.date(2026, 4, 8), 6) == ["2026-04-01"]
    kept = spark.read.parquet(target)
    assert sorted(r["log_file"] for r in kept.collect()) == ["errors-2026-04-02.log", "errors-2026-04-08.log"]
