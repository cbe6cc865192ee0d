"""Secrets against plain Python, and the randomness tests on strings of known origin."""

from __future__ import annotations

import hashlib
import random
import re
import string

import pytest

from folioflow.llm import secrets
from folioflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ASSIGN = r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain_base(text):
    text = text or ""
    spans = [(m.start(), 0, "assign", m.end()) for m in re.finditer(ASSIGN, text) if len(m.group(2)) >= 6]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def test_query_agrees_with_plain_expressions(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = {r["doc_id"]: r for r in QUERIES["op7_randomness_battery"](spark, FOLDER).collect()}
    assert set(found) == set(docs)
    for doc_id, text in docs.items():
        base, got = plain_base(text), found[doc_id]
        written = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert got["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert [got[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(x == k for x, _, _ in base) for k in ("assign", "access", "hex")]
        assert set(filter(None, written.split(","))) <= set(filter(None, got["spans"].split(",")))


@pytest.fixture(scope="module")
def model(spark):
    return secrets.fitted(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


@pytest.mark.parametrize("alphabet", ["0123456789abcdef", string.ascii_letters + string.digits, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"])
def test_random_strings_pass_the_battery_and_are_no_ordinary_text(model, alphabet):
    draw = random.Random(1)
    values = [model.p_value("".join(draw.choice(alphabet) for _ in range(40))) for _ in range(300)]
    assert sum(p is not None and p < 1e-4 for p in values) >= 280


@pytest.mark.parametrize("text", ["a" * 40, "ab" * 20, "abcdefghijklmnopqrstuvwxyz", "internationalisationoftheworlds", "0123456789" * 4, "/usr/local/share/doc/readme/files"])
def test_regular_and_ordinary_strings_do_not(model, text):
    p = model.p_value(text)
    assert p is None or p > 1e-4


def test_odd_rows_redaction_and_false_discovery_control(spark):
    draw = random.Random(4)
    keys = ["".join(draw.choice(string.ascii_letters + string.digits) for _ in range(44)) for _ in range(5)]
    plain = "some quite ordinary words about nothing at all in particular andsomeverylongwordsthatgoonandon "
    rows = [(k, plain * 20 + f"\U0001f600 {key} end", "x", None) for k, key in enumerate(keys)]
    rows += [(10, None, None, 3), (11, "", "", 0), (None, 'say Token: "abcdefgh" and AKIA' + "A1" * 8, "x", 1), (10, None, None, 3)]
    rows += [(12, "ſecret=abcdefg ToKen=abcdefg", "x", 5), (13, plain * 4000 + "password=hunter22", "x", 9), (14, "f" * 30, "x", 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found string, n_chars int")
    got = {}
    for r in secrets.found(docs).collect():
        got.setdefault(r["doc_id"], []).append([tuple(s) for s in r["found"]])
    for k, key in enumerate(keys):
        start = rows[k][1].index(key)
        assert got[k] == [[("random", start, start + 44)]]
    assert got[10] == [[], []] and got[11] == [[]] and got[12] == [plain_base(rows[9][1])] and got[14] == [[("hex", 0, 30)]]
    assert got[None] == [plain_base(rows[7][1])] and len(got[None][0]) == 2 and got[13] == [plain_base(rows[10][1])]
    clean = secrets.redacted(docs)
    assert clean.columns == docs.columns
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in clean.collect()}
    assert texts[0][0] == rows[0][1].replace(keys[0], "[SECRET]") and texts[0][1] == len(texts[0][0])
    assert texts[None][0] == "say [SECRET]\" and [SECRET]" and texts[10] == (None, 3) and texts[11] == ("", 0)
    assert secrets.digest(secrets.found(docs.limit(0))).count() == secrets.redacted(docs.limit(0)).count() == 0


def test_tokens_between_signs_are_found_and_the_words_beside_them_stay(spark):
    draw = random.Random(8)
    chars = string.ascii_letters + string.digits
    keys = ["".join(draw.choice(chars) for _ in range(40)) for _ in range(6)]
    frames = ["see /srv/my-app/{}/end", "a_long-name/{}", "/srv/app/{}", "old-{}_new", "ordinary-words/{}=", "/a_b/{}/c-d"]
    plain = "some ordinary words of the-usual-kind/with_signs/in-between-them and andsomelongwordsthatgoon "
    rows = [(k, plain * 20 + frame.format(key)) for k, (frame, key) in enumerate(zip(frames, keys))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = secrets.fitted(docs)
    for r in secrets.found(docs, model).collect():
        text, key = rows[r["doc_id"]][1], keys[r["doc_id"]]
        at = text.index(key)
        (span,) = [tuple(s) for s in r["found"]]
        assert span[0] == "random" and span[1] <= at and at + 40 <= span[2] and span[1] >= len(plain) * 20
    for r in secrets.redacted(docs, model).collect():
        assert keys[r["doc_id"]] not in r["text"] and r["text"].startswith(plain * 20)


def test_candidates_are_the_run_and_its_segments():
    run = "x" * 25 + "/" + "y" * 19 + "-" + "Z" * 30 + "=="
    assert [[f"see {run} end"[a:b] for a, b in places] for places in secrets.candidates(f"see {run} end")] == [[run, "x" * 25, "Z" * 30 + "=="]]
    assert list(secrets.candidates("q" * 30)) == [[(0, 30)]] and list(secrets.candidates("")) == []
