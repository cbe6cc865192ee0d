"""Personal data against plain Python."""

from __future__ import annotations

import hashlib
import re

import pytest

from folioflow.llm import pii
from folioflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SHAPES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 if k % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def holds(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def plain_base(text: str | None) -> list[tuple[str, int, int]]:
    kinds = list(SHAPES)
    spans = [
        (m.start(), rank, kind, m.end())
        for rank, kind in enumerate(kinds)
        for m in re.finditer(SHAPES[kind], text or "")
        if holds(kind, m.group())
    ]
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


TEXTS = [
    None, "", "x", "a@b.cc_x@d.ee", "x@y.z@w.v", "me.you+z@a-b.c-d.e. @q.r a@b a@b. ..@..", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 and 41111111111111111111 4111111111111111", "+1 (017) 555-7713 +1 2 +49 30 1234567890123 +1",
    "é\U0001f600 a@b.c ü 1.1.1.1\n+1 555 555 5555 55", "1.1.1.1 4111 1111 1111 1111@a.b", "a" * 5000 + "@" + "b.c" * 3000, "9" * 6000,
    "1 " * 4000, "+1" + " " * 5000, ("k@l.m " * 300), "..1.2.3.4", "1..2.3.4.5",
]


def test_base_spans_agree_with_plain_expressions(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in pii.with_base(docs).collect()}
    for k, text in enumerate(TEXTS):
        assert found[k] == plain_base(text), text and text[:80]


def test_strings_and_their_neighbours(spark):
    text = "  Call\tme 12a now\n\n é a@b x9 "
    docs = spark.createDataFrame([(1, text), (2, None), (3, "none here"), (4, "7")], "doc_id long, text string")
    found = {r["doc_id"]: [tuple(s) for s in r["strings"]] for r in pii.with_strings(docs).collect()}
    assert found[1] == [(10, 13, "12a", "me", "now"), (22, 25, "a@b", "é", "x0"), (26, 28, "x9", "a@b", "")]
    assert [text[s:e] for s, e, *_ in found[1]] == ["12a", "a@b", "x9"]
    assert (found[2], found[3], found[4]) == ([], [], [(0, 1, "7", "", "")])


def test_query_agrees_with_plain_expressions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    found = {r["doc_id"]: r for r in QUERIES["op5_bootstrapped_contexts"](spark, FOLDER).collect()}
    assert len(found) == len(docs)
    for d in docs:
        base, got = plain_base(d["text"]), found[d["doc_id"]]
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert got["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        for kind in SHAPES:
            assert got[f"n_{kind}"] == sum(k == kind for k, _, _ in base)
        assert set(filter(None, text.split(","))) <= set(filter(None, got["spans"].split(",")))


def test_contexts_find_unseen_identifiers_and_leave_others(spark):
    rows = [(k, f"please write to mailto: u{k}@mail.example today") for k in range(8)]
    rows += [(20, "his handle mailto: user#77 today"), (21, "the year 1999 was long"), (22, "user#77 came again")]
    rows += [(30, None), (31, ""), (20, "his handle mailto: user#77 today"), (None, "mailto: key9 today")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("x", "y")
    found = pii.found(docs.selectExpr("*", "1 as value", "2 as seed")).collect()
    spans = [(r["doc_id"], [tuple(s) for s in r["spans"] if s["kind"] == "context"]) for r in found]
    assert len(spans) == len(rows)
    at = rows[8][1].index("user#77")
    assert spans.count((20, [("context", at, at + 7)])) == 2
    assert (22, [("context", 0, 7)]) in spans and (None, [("context", 8, 12)]) in spans and (21, []) in spans


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert pii.digest(pii.found(docs)).count() == len(rows)
