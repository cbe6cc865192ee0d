"""Change sets of listings, and the job that works on them."""

from __future__ import annotations

import datetime as dt

import pytest

from folioflow.plans.jobs import register_changed_invoices
from folioflow.sinks.registry import InvoiceRegistry
from folioflow.sources.snapshots import ListingLog, listing_changes
from tests.samples import Landing, invoice

NOW = dt.datetime(2026, 4, 8, 9, 0)
LATER = NOW + dt.timedelta(seconds=1)


def listed(spark, *rows):
    return spark.createDataFrame(list(rows), "path string, modificationTime timestamp_ntz, length long")


def found(changes):
    return {row["path"]: (row["change"], row["modificationTime"], row["length"]) for row in changes.collect()}


def test_changes(spark):
    before = listed(spark, ("a", NOW, 1), ("b", NOW, 1), ("c", NOW, 1), ("d", None, 1), ("e", None, None), ("f", NOW, 1))
    now = listed(spark, ("a", NOW, 1), ("b", LATER, 1), ("c", NOW, 2), ("d", None, 1), ("e", NOW, None), ("g", NOW, 0), (None, NOW, 1))
    assert found(listing_changes(before, now)) == {
        "b": ("changed", LATER, 1), "c": ("changed", NOW, 2), "e": ("changed", NOW, None), "f": ("gone", NOW, 1), "g": ("new", NOW, 0),
    }
    assert {change for change, *_ in found(listing_changes(before.limit(0), before)).values()} == {"new"}
    assert {change for change, *_ in found(listing_changes(before, now.limit(0))).values()} == {"gone"}
    assert found(listing_changes(before.limit(0), now.limit(0))) == {}


def test_runs_see_each_change_once(spark, tmp_path):
    log = ListingLog(spark, str(tmp_path / "log"))
    first, second = listed(spark, ("a", NOW, 1), ("b", NOW, 1)), listed(spark, ("b", LATER, 3), ("c", NOW, 1))
    assert set(found(log.take("1", first))) == {"a", "b"}
    # Not committed: the folder still counts as never seen, and the run gets its own set again.
    assert log.listing().count() == 0
    assert set(found(log.take("1", second))) == {"a", "b"}
    log.commit("1", NOW)
    assert {p: c for p, (c, *_) in found(log.take("2", second)).items()} == {"a": "gone", "b": "changed", "c": "new"}
    log.commit("2", NOW)
    assert found(log.take("3", second)) == {}
    log.commit("3", NOW)
    log.compact("folded", NOW)
    assert sorted(tuple(r) for r in log.listing().collect()) == [("b", LATER, 3), ("c", NOW, 1)]
    # A file that comes back is new again.
    assert {p: c for p, (c, *_) in found(log.take("4", first)).items()} == {"a": "new", "b": "changed", "c": "gone"}


def test_job_touches_only_what_changed(spark, tmp_path, monkeypatch):
    landing = Landing(tmp_path)
    registry, log = InvoiceRegistry(spark, str(tmp_path / "invoices")), ListingLog(spark, str(tmp_path / "log"))
    landing.put("xml", "a.xml", invoice(SAPBillingDocumentNumber="1"))
    landing.put("xml", "bad.xml", "<x")

    def run(batch_id):
        judged = register_changed_invoices(registry, log, landing.folders.xml, NOW, batch_id)
        return {row["name_file"]: row["status"] for row in judged.collect()}

    def stopped(*_, **__):
        raise OSError("stopped before the commit")

    with monkeypatch.context() as patch:
        patch.setattr(log, "commit", stopped)
        with pytest.raises(OSError):
            run("1")
    # b.xml comes between the attempts: it belongs to the next run.
    landing.put("xml", "b.xml", invoice(SAPBillingDocumentNumber="2"))
    assert run("1") == {"/bad.xml": "failed"}
    assert run("2") == {"/b.xml": "accepted"}
    assert run("3") == {}
    landing.put("xml", "bad.xml", invoice(SAPBillingDocumentNumber="3"))
    assert run("4") == {"/bad.xml": "accepted"}
    assert sorted(r["FacInterno"] for r in registry.headers().collect()) == ["1", "2", "3"]
