"""Tables that jobs write on the way don't stay in the shared folder."""

from __future__ import annotations

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq

from folioflow.catalog import landed_queries
from folioflow.plans.jobs import companion_records, register_guides, register_landed_invoices
from folioflow.session import cut_lineage, settle, shared_folder
from folioflow.sinks.registry import GuideRegistry, InvoiceRegistry
from folioflow.sources.landing import PDF_FILES, XML_FILES, list_files

AS_OF = dt.datetime(2024, 1, 2)


def _tables(spark):
    return {name for name in os.listdir(shared_folder(spark).removeprefix("file:")) if name.startswith("rows-")}


def _rows(spark, names):
    return sorted(spark.read.parquet(f"{shared_folder(spark)}/{name}").count() for name in names)


def _orders(tmp_path, keys):
    columns = {"o_orderkey": keys, "o_custkey": [7] * len(keys), "o_orderstatus": ["O"] * len(keys), "o_orderdate": [dt.datetime(2001, 2, 3)] * len(keys)}
    pq.write_table(pa.table(columns), tmp_path / "orders.parquet")
    return str(tmp_path)


def test_only_what_is_settled_stays(spark):
    before = _tables(spark)

    def inner():
        return cut_lineage(spark.range(10)).where("id > 4")

    def outer():
        return settle(inner).where("id > 5").unionByName(cut_lineage(spark.range(1)))

    kept = settle(outer)
    assert sorted(r["id"] for r in kept.collect()) == [0, 6, 7, 8, 9]
    assert _rows(spark, _tables(spark) - before) == [5]
    # Outside nothing is taken away, and a failure ends the collecting.
    try:
        settle(lambda: cut_lineage(spark.range(3)).select("none"))
    except Exception:  # noqa: BLE001
        pass
    assert cut_lineage(spark.range(3)).count() == 3 and kept.count() == 5


def test_landing_keeps_no_outcome_of_a_file_that_landed(spark, tmp_path):
    before = _tables(spark)
    folders = landed_queries.land(spark, _orders(tmp_path, [1, 2, 4]), ("pdf", "txt", "xml"))
    assert [len(os.listdir(f.removeprefix("file:"))) for f in (folders.pdf, folders.txt, folders.xml)] == [3, 3, 3]
    assert set(_rows(spark, _tables(spark) - before)) == {0}


def test_a_batch_of_invoices_keeps_what_it_works_on_and_returns(spark, tmp_path):
    folders = landed_queries.land(spark, _orders(tmp_path, [1, 2, 4]), ("xml",))
    registry, files = InvoiceRegistry(spark, f"{tmp_path}/invoices"), list_files(spark, folders.xml, XML_FILES)
    before = _tables(spark)
    register_landed_invoices(registry, files, folders.xml, AS_OF, "a")
    # The files without the registered ones, the same dealt out, and the judged documents.
    assert len(_tables(spark) - before) == 3 and registry.headers().count() == 3


def test_a_batch_of_guides_keeps_what_it_returns_and_what_it_registered(spark, tmp_path):
    folders = landed_queries.land(spark, _orders(tmp_path, [1, 2, 4]), ("pdf", "txt"))
    registry, pdfs = GuideRegistry(spark, f"{tmp_path}/guides"), list_files(spark, folders.pdf, PDF_FILES)
    records = companion_records(spark, folders.txt, pdfs)
    before = _tables(spark)
    judged = register_guides(registry, pdfs, records, AS_OF, "a", folders)
    # The judged PDFs and the accepted ones.
    assert len(_tables(spark) - before) == 2
    assert judged.where("status = 'accepted'").count() == registry.read().count() == 3
    routed = [name for _, _, names in os.walk(folders.routed.removeprefix("file:")) for name in names]
    assert sorted(routed) == sorted(os.listdir(folders.pdf.removeprefix("file:")))
