"""Parsing rules, value by value."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from folioflow.functions import names, numbers, records, text
from folioflow.functions.addresses import recipients
from tests.samples import record


def each(spark, values, column):
    """``column`` over every value, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [row[0] for row in rows.orderBy("i").select(column(F.col("x"))).collect()]


def indexed(spark, *documents):
    return records.index_records(spark.createDataFrame([(d,) for d in documents], "value string"))


def test_quantity_keeps_its_scale_and_rejects_what_is_no_number(spark):
    cases = {
        "1.000": "1.000", "(5)": "-5", "-0.00": "0.00", "1e3": "1000", "1.50e1": "15.0", "1.5e-3": "0.0015",
        "1,000.50": "1000.50", ".5": "0.5", "5.": "5", " 7 ": "7", "5-": "-5", "007.50": "7.50", "0": "0",
        "abc": None, "": None, "+5-": None, ".": None, "(5": None, "1.2.3": None, "cantidad-invalida": None, None: None,
    }
    assert each(spark, list(cases), numbers.quantity_text) == list(cases.values())


def test_amount_is_tolerant(spark):
    cases = {
        "1,5": "1.50", "2,0": "2.00", "abc": "0.00", "": "0.00", None: "0.00", "1,234": "1.23", "1.234,56": "0.00",
        "1,234,567": "1234567.00", " 3.456 ": "3.46", "5-": "-5.00", "-5": "-5.00", "-5-": "0.00", "1e3": "0.00",
        "1,000.5": "1000.50", ",5": "0.50", "99999999999999999999": None,
    }
    found = each(spark, list(cases), numbers.tolerant_amount)
    assert found == [None if v is None else Decimal(v) for v in cases.values()]


def test_part_number(spark):
    cases = {
        "000000000007720345": "7720345", "ABC123": None, "2147483647": "2147483647", "2147483648": None, " 12 ": "12",
        "-7": "-7", "1.5": None, "1e3": None, "": None, None: None,
    }
    assert each(spark, list(cases), numbers.part_number) == list(cases.values())


def test_dates(spark):
    day = dt.datetime(2026, 4, 7)
    cases = {
        "2026-04-07": day, "2026-4-7": day, "4/7/2026": day, "2026/04/07": day,
        "4/7/2026 8:22:58 PM": day.replace(hour=20, minute=22, second=58),
        "2026-04-07T08:22:58": day.replace(hour=8, minute=22, second=58), "12:00": None, "2026-13-01": None, "": None,
        "soon": None, "2026-02-30": None, None: None,
    }
    assert each(spark, list(cases), numbers.loose_timestamp) == list(cases.values())


def test_compact_date(spark):
    assert each(spark, [None, "", "2026-04-27", "20260427"], text.compact_date) == ["", "", "20260427", "20260427"]


def test_trim_takes_every_unicode_blank(spark):
    assert each(spark, ["\u00a0 a\u3000\t", "\x1ca"], text.trim_blanks) == ["a", "\x1ca"]


@pytest.mark.parametrize(
    ("name", "key", "companion"),
    [
        ("20990011224-09-T001-00204617.pdf", "GR-0T001-0204617", "20990011224-T001-0204617.txt"),
        ("20990011224-09-T001-00309128.pdf", "GR-0T001-0309128", "20990011224-T001-0309128.txt"),
        ("20990011224-09-T001.pdf", None, None),
        ("a-b-c-123.pdf", None, None),
        ("a-b-c-1234.pdf", "GR-0c-234.pdf", "a-c-234.pdf.txt"),
    ],
)
def test_keys_from_pdf_names(spark, name, key, companion):
    assert each(spark, [name], names.guide_key_from_pdf) == [key]
    assert each(spark, [name], names.companion_of_pdf) == [companion]


def test_pattern_from_record_name(spark):
    cases = {"a-T001-0204617.txt": "a-*-T001-?0204617*.pdf", "a-T001-123.txt": None, "a-b-c-0204617.txt": None, "": None}
    assert each(spark, list(cases), names.pdf_pattern_of_companion) == list(cases.values())


def test_relative_path(spark):
    def below(root):
        return lambda path: names.relative_to(path, root)

    assert each(spark, [r"C:\drop\in\x.xml"], below(r"c:\DROP\in" + "\\")) == [r"\x.xml"]
    assert each(spark, ["/in2/x.xml"], below("/in")) == ["2/x.xml"]
    assert each(spark, ["/other/x.xml", "/in/x.xml"], below(" ")) == ["/other/x.xml", "/in/x.xml"]


def test_attributes_match_whole_keys_and_first_line_wins(spark):
    row = indexed(
        spark,
        "Z;Doc;7;one\r\nZ;DocNumber;7;two\nZ;MyDoc;7;three\rQ;Doc;8;four\nZ;doc;9;five\n\n;;\nX",
    ).first()
    assert row["attributes"] == {
        "Doc": "one", "DocNumber": "two", "MyDoc": "three", "doc": "five",
    }


def test_missing_attribute_is_empty_and_reported(spark):
    row = indexed(spark, "A;Serie;1;T001").select(
        records.attribute(F.col("attributes"), "Inexistente"),
        records.missing_attributes(F.col("attributes"), ["Serie", "Inexistente"]),
    ).first()
    assert tuple(row) == ("", ["Inexistente:Attribute not found  "])


def test_embedded_semicolons_stay(spark):
    assert indexed(spark, "A;RznSocEmis;1;NORTHERN; S.A.C.").first()["attributes"] == {"RznSocEmis": "NORTHERN; S.A.C."}


def test_labels(spark):
    fields = F.col("fields")
    df = indexed(
        spark,
        "E;DescripcionAdicsunat;1;T001-001  |  Orden de Compra Cliente 123  |  Nota de Venta SAP 456",
        "E;DescripcionAdicsunat;1;Factura Sistema 789",
        "E;DescripcionAdicsunat;1;x | Factura Sistema 99",
        "A;Serie;1;T001",
    )
    found = [
        tuple(row)
        for row in df.select(
            records.labelled_value(fields, "Orden de Compra Cliente"),
            records.labelled_value(fields, "Factura"),
            records.labelled_value(fields, "Factura Sistema"),
            records.missing_labels(fields, ["Factura"]),
        ).collect()
    ]
    missing = ["Factura:Description not found  "]
    # The first field still carries the line's own prefix, so a label in it is never found.
    assert found == [("123", "", "", missing), ("", "", "", missing), ("", "Sistema 99", "99", []), ("", "", "", missing)]


def test_sample_record(spark):
    row = indexed(spark, "\ufeff" + record()).first()
    assert row["attributes"]["Serie"] == "T001"
    assert row["attributes"]["RUCTranspor"] == "20111"
    assert row["fields"][1:] == [
        "Factura Sistema 9000204617", "Turno B", "Documento Despacho 8300456789", "Nota de Venta SAP 61", "Muelle 12",
        "Documento Ref F500-7", "Orden de Compra Cliente 52",
    ]


def test_recipients(spark):
    raw = "a@x.com; b@y.com, A@X.COM \n c@z.com\r\n"
    assert each(spark, [raw, " ;, "], recipients) == [["a@x.com", "b@y.com", "c@z.com"], []]
