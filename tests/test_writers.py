"""Several writers on one registry: what two of them hold is there once, and stays with the first commit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from folioflow.schemas import GUIDE_SCHEMA, HEADER_SCHEMA
from folioflow.sinks.registry import GuideRegistry, InvoiceRegistry

NOW = dt.datetime(2026, 4, 8)


def filled(spark, schema, rows, names):
    columns = [part.split() for part in schema.split(", ")]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).withColumn("Auditoria_Deleted", F.lit(False))
    return df.select(*((F.col(n) if n in df.columns else F.lit(None)).cast(kind).alias(n) for n, kind in columns))


def guides(spark, *rows):
    return filled(spark, GUIDE_SCHEMA, rows, ["greName", "delivery", "razoTrans"])


def test_two_writers_of_one_guide(spark, tmp_path):
    root = str(tmp_path / "guides")
    first, second = GuideRegistry(spark, root), GuideRegistry(spark, root)
    first.append("0", guides(spark, ("G0", "D0", "old")), NOW)
    # Both look at the same state before either commits.
    seen = first.last_sequence(), second.last_sequence()
    assert seen == (1, 1)
    first.append("a", guides(spark, ("G1", "D1", "first"), ("G2", "D2", "first")), NOW, seen[0])
    second.append("b", guides(spark, ("g1", "D1", "second"), ("G3", "D3", "second")), NOW, seen[1])
    # One that saw both is compared with nothing.
    second.append("c", guides(spark, ("G4", "D4", "third")), NOW, second.last_sequence())
    log = {r["batch_id"]: (r["sequence"], r["seen"]) for r in first.log().collect()}
    assert log == {"b_0": (1, 0), "b_a": (2, 1), "b_b": (3, 1), "b_c": (4, 3)}
    found = sorted((r["greName"], r["razoTrans"]) for r in first.read().collect())
    assert found == [("G0", "old"), ("G1", "first"), ("G2", "first"), ("G3", "second"), ("G4", "third")]
    first.snapshot("s", NOW)
    assert sorted((r["greName"], r["razoTrans"]) for r in second.read().collect()) == found
    assert second.known(spark.createDataFrame([("g1",), ("g9",)], "k string")).collect()[0][0] == "g1"


def test_names_are_those_of_the_rows_written(spark, tmp_path):
    # Rows that come out otherwise each time they are made.
    registry = GuideRegistry(spark, str(tmp_path / "guides"))
    registry.append("a", guides(spark, ("G1", "D1", "x"), ("G2", "D2", "x")).withColumn("greName", F.uuid()), NOW)
    assert sorted(r["key"] for r in registry.names().collect()) == sorted(r["greName"] for r in registry.read().collect())
    invoices = InvoiceRegistry(spark, str(tmp_path / "invoices"))
    invoices.add("a", filled(spark, HEADER_SCHEMA, [("x", "1")], ["NameFile", "FacInterno"]).withColumn("NameFile", F.uuid()), NOW)
    assert [r["key"] for r in invoices.names().collect()] == [r["NameFile"] for r in invoices.headers().collect()]


def test_a_number_is_claimed_once(spark, tmp_path):
    registry = GuideRegistry(spark, str(tmp_path / "guides"))
    assert registry._claimed(1) and not registry._claimed(1) and registry._claimed(3)
    registry.append("a", guides(spark, ("G1", "D1", "x")), NOW)
    registry.append("b", guides(spark, ("G2", "D1", "x")), NOW)
    assert sorted(r["sequence"] for r in registry.log().collect()) == [2, 4]
    # Claims without a commit are no batches; nothing was committed between, so nothing is lost.
    assert sorted(r["greName"] for r in registry.read().collect()) == ["G1", "G2"]


def test_two_writers_of_one_invoice(spark, tmp_path):
    root = str(tmp_path / "invoices")
    first, second = InvoiceRegistry(spark, root), InvoiceRegistry(spark, root)
    for registry, name, files in ((first, "a", ["/X.xml", "/y.xml"]), (second, "b", ["/x.xml", "/z.xml"])):
        headers = filled(spark, HEADER_SCHEMA, [(f, f"{name}{f}") for f in files], ["NameFile", "FacInterno"])
        registry.write("headers", name, headers)
        registry.write("lines", name, headers.select("FacInterno", "NumPed", *(F.lit("v").alias(c) for c in ("Cod_Material", "Descripcion", "Cantidad"))))
        registry.write_names(name, headers.select("NameFile"))
        registry.commit(name, NOW, seen=0)
    wanted = ["a/X.xml", "a/y.xml", "b/z.xml"]
    assert sorted(r["FacInterno"] for r in first.headers().collect()) == wanted
    assert sorted(r["FacInterno"] for r in first.lines().collect()) == wanted
