"""Rows that are written down, and orders dealt out by how many there are."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.catalog import guide_queries, invoice_queries, synthetic
from folioflow.functions.records import index_records
from folioflow.operators import invoices, reconcile
from folioflow.session import cut_lineage


def test_rows_are_kept_as_a_table_read_by_column(spark):
    rows = spark.range(1000).withColumn("text", F.repeat(F.lit("x"), 1000)).withColumn("at", F.lit("2001-01-01").cast("timestamp_ntz"))
    kept = cut_lineage(rows)
    assert kept.dtypes == rows.dtypes and sorted(kept.collect()) == sorted(rows.collect())
    plan = kept.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_a_task_makes_a_bounded_number_of_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(synthetic, "TASK_ROWS", 10)
    table = spark.range(205).withColumnRenamed("id", "k").coalesce(1)
    dealt = synthetic.spread(table, "k")
    assert dealt.rdd.getNumPartitions() == 21 and dealt.count() == 205


def test_only_the_columns_asked_for_are_picked(spark, monkeypatch):
    rows = spark.createDataFrame(
        [("G", "2001-01-02", "b", "accepted", "two"), ("g", "2001-01-01", "a", "accepted", "one"), ("H", "2001-01-01", "c", "failed", "x")],
        "gre_name string, effective_time string, path string, status string, delivery string",
    )
    monkeypatch.setattr(guide_queries, "_judged", lambda *_: rows)
    picked = guide_queries._accepted(spark, "", "delivery")
    assert [tuple(r) for r in picked.collect()] == [("g", "2001-01-01", "a", "one")]


def _orders(tmp_path, rows):
    import datetime as dt

    import pyarrow as pa
    import pyarrow.parquet as pq

    made = [(k, 7, s, dt.datetime(2001, 2, 3)) for k, s in rows]
    columns = dict(zip(("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"), map(list, zip(*made))))
    pq.write_table(pa.table(columns), tmp_path / "orders.parquet")
    return str(tmp_path)


def test_the_registered_check_of_invoices_sees_names_only(spark, tmp_path, monkeypatch):
    checked, check = [], reconcile.not_registered

    def seen(candidates, *rest):
        checked.append(candidates.columns)
        return check(candidates, *rest)

    monkeypatch.setattr(reconcile, "not_registered", seen)
    folder = _orders(tmp_path, [(1, "O"), (2, "F"), (2, "O"), (4, "O"), (4, "O"), (None, "O")])
    found = invoice_queries.invoices_to_register(spark, folder).collect()
    assert sorted(r["name_file"] for r in found if r["name_file"]) == ["/01_INV_F113_000000000001.xml", "/01_INV_F113_000000000004.xml"]
    assert checked and all("value" not in columns for columns in checked)


def test_only_the_header_fields_asked_for_leave_the_parser(spark, tmp_path):
    folder = _orders(tmp_path, [(k, "O") for k in range(1, 200)])
    documents = synthetic.invoice_documents(synthetic.orders(spark, folder)).select("invoice_id", "name_file", "value")
    whole, part = invoices.evaluate(documents), invoices.evaluate(documents, ("NumPed", "referenceDocNumber"))
    assert "Cliente" not in part.columns and "NumPed" in part.columns
    assert sorted(map(repr, whole.select(part.columns).collect())) == sorted(map(repr, part.collect()))


def test_entries_are_sorted_natively(spark):
    """A comparing lambda would be interpreted for every pair of lines of every record."""
    indexed = index_records(spark.createDataFrame([("A;k;1;b\nA;a;1;x\nA;k;2;c",), (None,)], "value string"))
    assert "array_sort(" not in indexed._jdf.queryExecution().optimizedPlan().toString()
    assert [r["attributes"] for r in indexed.select("attributes").collect()] == [{"a": "x", "k": "b"}, None]
