"""Quality rules against SQL and plain Python."""

from __future__ import annotations

import re
from collections import Counter

from folioflow.llm import line_quality
from folioflow.llm.queries import ORACLE, QUERIES
from tests.compare import difference, oracle

FOLDER = "/root/testdata/sf0.001"


def test_query_agrees_with_sql(spark):
    assert difference(QUERIES["op2_line_frequency"](spark, FOLDER), oracle(FOLDER), ORACLE["op2_line_frequency"]) is None


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_of_odd_texts(spark):
    texts = [
        None, "", " \n\n\t", "a", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "x " * 9, "x " * 8, "1 2 3 4 5 6 7 8 9 " * 40,
        "é\U0001f600 # * $ % & | < >\n\r\né\U0001f600 # * $ % & | < >", "p\x0bq\x0cr\x1cs t", "l\nl\nl \nL", "y\n" * 20_000, " ".join(map(str, range(30_000))),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = {r["doc_id"]: tuple(r[n] for n in names) for r in line_quality.measured(docs).collect()}
    for k, text in enumerate(texts):
        assert found[k] == plain_counts(text), repr((text or "")[:40])


def test_shared_lines_go_depleted_documents_are_rejected_copies_stay(spark):
    def own(k, n):
        return " ".join(f"own{k}w{i}" for i in range(n))

    menu = "Home  | ABOUT | Contact us and read all our many pages here now please do"
    rows = [(k, f"{own(k, 30)}\n{menu.lower()}\n{own(k + 1000, 5)}", "a", 0) for k in range(8)]
    rows += [(20, f"{menu}\n{own(20, 6)} and some more words so that there are twenty of them", "a", 0)]
    rows += [(21, f"{own(21, 5)}\n{menu}\n{menu}\n{menu}", "a", 0), (22, f"{own(22, 30)}\n{menu}", "b", 0)]
    rows += [(30 + k, f"{own(30, 40)}\nsecond line of the copied text {own(31, 4)}", "a", 0) for k in range(9)]
    rows += [(50, None, None, None), (51, "", "a", 0), (None, own(60, 30), None, 0), (0, rows[0][1], "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int").selectExpr("*", "1 as host", "2 as key", "'x' as removed")
    found = {}
    for r in line_quality.verdicts(docs, max_documents=5).collect():
        found.setdefault(r["doc_id"], []).append((r["kept"], r["n_removed"]))
    assert all(found[k] == [(True, 16)] * (2 if k == 0 else 1) for k in range(8))
    assert found[20] == [(True, 16)] and found[21] == [(False, 48)] and found[22] == [(True, 0)]
    assert all(found[30 + k] == [(True, 0)] for k in range(9))
    assert found[50] == found[51] == [(False, 0)] and found[None] == [(True, 0)]
    cleaned = line_quality.cleaned(docs, max_documents=5)
    assert cleaned.columns == docs.columns
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cleaned.collect()}
    assert texts[1] == (f"{own(1, 30)}\n{own(1001, 5)}", len(f"{own(1, 30)}\n{own(1001, 5)}"))
    assert texts[22] == (rows[10][1], 0) and 21 not in texts and cleaned.count() == 8 + 1 + 1 + 1 + 9 + 1
    assert line_quality.verdicts(docs.limit(0)).count() == line_quality.cleaned(docs.limit(0)).count() == 0


def test_menu_of_pages_with_one_own_line_each_is_frequent(spark):
    """Which line of a menu has the least key must not decide how many pages count apart."""
    menu = "\n".join(f"menu entry {i} leads to another place" for i in range(30))
    rows = [(k, f"{menu}\nown line {k} of this page only", "a") for k in range(500)]
    rows += [(1000 + k, f"{menu}\nthe same text copied", "b") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r["doc_id"]: (r["kept"], r["n_removed"]) for r in line_quality.verdicts(docs).collect()}
    assert all(found[k] == (False, 30 * 7) for k in range(500))
    assert all(found[1000 + k] == (True, 0) for k in range(100))
