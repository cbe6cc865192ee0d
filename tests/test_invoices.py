"""Invoice XML: flattening, document validity, target rows."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from folioflow.operators import invoices
from tests.samples import invoice, line


def judged(spark, *documents):
    rows = [(f"/in/{i}.xml", f"/{i}.xml", text) for i, text in enumerate(documents)]
    df = invoices.evaluate(spark.createDataFrame(rows, "path string, name_file string, value string"))
    return [row.asDict(recursive=True) for row in df.orderBy("path").collect()]


def test_header_and_line(spark):
    (row,) = judged(spark, invoice())
    assert row["status"] == "accepted"
    assert (row["TipDoc"], row["Serie"], row["Numero"], row["Fecha"]) == ("01", "F500", "0000042", "2026-03-02")
    assert (row["ConPag"], row["Monto"], row["FacInterno"]) == ("30 días", "77.5", "3141")
    assert row["checked_lines"] == [
        {"line_no": 0, "Cod_Material": "7720345", "Descripcion": "LAMP BLUE", "Cantidad": "1.000"}
    ]


def test_target_rows(spark):
    df = spark.createDataFrame([("/in/a.xml", "/a.xml", invoice(paymentDueDate="2026-04-01"))], "path string, name_file string, value string")
    accepted = invoices.evaluate(df)
    header = invoices.header_rows(accepted).first().asDict()
    assert (header["NameFile"], header["Fecha"], header["FecVenci"]) == ("/a.xml", "20260302", "20260401")
    assert (header["Sunat"], header["Estado"], header["indNotificacion"]) == ("No procesado", "Pendiente", 0)
    assert len(header) == 28


def test_missing_nodes_are_empty(spark):
    (row,) = judged(spark, '<ns0:r xmlns:ns0="u"><ns0:documentType>01</ns0:documentType></ns0:r>')
    assert (row["status"], row["TipDoc"], row["Cliente"]) == ("accepted", "01", "")
    assert (row["MontoDetraccion"], row["PorcentajeDet"], row["checked_lines"]) == (0, 0, [])


def test_amounts(spark):
    rows = judged(
        spark, invoice(MontoDetraccion="1,5", PorcentajeDet="2,0"), invoice(MontoDetraccion="monto-invalido", PorcentajeDet="")
    )
    assert [(r["MontoDetraccion"], r["PorcentajeDet"]) for r in rows] == [(Decimal("1.50"), Decimal("2.00")), (0, 0)]


def test_reference_document_only_for_notes(spark):
    rows = judged(spark, *(invoice(documentType=t, referenceDocNumber="REF-9") for t in ("01", "07", "08")))
    assert [r["referenceDocNumber"] for r in rows] == ["", "REF-9", "REF-9"]


def test_correct_spelling_of_the_number_tag_is_not_read(spark):
    (row,) = judged(spark, invoice(sequentilaNumber=None, sequentialNumber="0000042"))
    assert row["Numero"] == ""


@pytest.mark.parametrize(
    "lines", [[line(part="ABC123")], [line(quantity="cantidad-invalida")], [line(), line(quantity=None)], [line(part=None)]]
)
def test_one_bad_line_fails_the_document(spark, lines):
    (row,) = judged(spark, invoice(lines=lines))
    assert (row["status"], row["reason"]) == ("failed", "bad_line")


def test_malformed_documents_do_not_stop_the_others(spark):
    rows = judged(spark, invoice()[:-5], invoice(), "", invoice().replace(' xmlns:ns0="urn:test"', ""))
    assert [r["reason"] for r in rows] == ["malformed_xml", None, "malformed_xml", "malformed_xml"]


def test_rows_affected(spark):
    rows = [("/in/a.xml", "/a.xml", invoice(lines=[line(part=str(i)) for i in range(120)])), ("/in/b.xml", "/b.xml", "<x")]
    df = invoices.evaluate(spark.createDataFrame(rows, "path string, name_file string, value string"))
    found = invoices.rows_affected(df).orderBy("path").select("rows_affected").collect()
    assert [r[0] for r in found] == [121, 0]
    assert invoices.line_rows(df.where(F.col("status") == "accepted")).count() == 120


@pytest.mark.parametrize("flatten", [invoices.flatten_document, invoices._flatten_any_prefix])
def test_flattening_rules(flatten):
    text = (
        '<ns0:r xmlns:ns0="u"><ns0:paymentMethod> \n </ns0:paymentMethod><ns0:billToName>A &amp; <b>B</b> C</ns0:billToName>'
        "<ns0:currencyCode>PEN</ns0:currencyCode><ns0:currencyCode>USD</ns0:currencyCode>"
        "<ns0:stocKLine><x><ns0:partNumber>9</ns0:partNumber></x><ns0:partNumber>1</ns0:partNumber>"
        "<ns0:partNumber>2</ns0:partNumber><ns0:quantity>3<!-- c -->4</ns0:quantity></ns0:stocKLine></ns0:r>"
    )
    header, lines = flatten(text)
    assert header == {"ns0:paymentMethod": "", "ns0:billToName": "A & B C", "ns0:currencyCode": "PEN"}
    assert lines == [{"part_number": "1", "description": "", "quantity": "34"}]


def test_prefix_counts_not_namespace():
    header, _ = invoices.flatten_document(
        '<r xmlns:ns0="u" xmlns:p="u"><p:docNumber>no</p:docNumber><ns0:docNumber>yes</ns0:docNumber></r>'
    )
    assert header == {"ns0:docNumber": "yes"}
