"""Runs by seed and extend against a plain search over all periods."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest

from folioflow.llm import repetition
from folioflow.llm.queries import QUERIES


def plain_runs(words: list, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    all_words, out = np.array([numbers[w] for w in words], np.int64), []
    for q in range(1, len(words) // times + 1):
        same = np.r_[False, all_words[:-q] == all_words[q:], False]
        edges = np.flatnonzero(same[1:] != same[:-1])
        for i, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - i + q < max(least, times * q):
                continue
            stretch = all_words[i : end + q]
            if not any((stretch[p:] == stretch[:-p]).all() for p in range(1, q)):
                out.append((i, end - i + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text: str | None, plant: bool = True) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if plant and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    spelt = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        len(runs), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2],
        hashlib.sha256(spelt.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_on_whole_table(spark):
    path = "/root/testdata/sf0.001"
    wanted = {r["doc_id"]: plain_digest(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = QUERIES["op13_periodic_runs"](spark, path).collect()
    assert len(rows) == len(wanted)
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == wanted[r["doc_id"]], r["doc_id"]
    assert any(w[0] for w in wanted.values())


@pytest.mark.parametrize("least,times", [(24, 3), (10, 3), (12, 5), (1, 3)])
def test_runs_of_random_sequences(least, times):
    draw = np.random.default_rng(least * 10 + times)
    met = 0
    for _ in range(250):
        words: list[int] = []
        while len(words) < 150:
            unit = draw.integers(0, 2 + draw.integers(0, 3), size=draw.integers(1, 40)).tolist()
            words += (unit * int(draw.integers(1, 6)))[: int(draw.integers(1, 120))]
        found = sorted(repetition.runs_of(np.array(words), least, times), key=lambda r: (r[0], r[2]))
        assert found == plain_runs(words, least, times)
        met += len(found)
    assert met > 50


def test_a_unit_whose_every_gram_comes_twice():
    """Words of 16 then come again inside the unit; longer grams are needed to see its lag."""
    shared = list(range(100, 120))
    unit = (shared + [1]) * 2 + (shared + [2]) * 2
    words = [7] + unit * 3 + [8]
    found = sorted(repetition.runs_of(np.array(words)), key=lambda r: (r[0], r[2]))
    assert found == plain_runs(words) and (1, len(unit) * 3, len(unit)) in found


def test_nested_and_touching_runs():
    inner = ["a", "b"] * 15 + ["x"]
    words = inner * 4 + ["c"] * 30 + ["d"] * 23 + ["e"] * 24
    found = sorted(repetition.runs_of(np.unique(words, return_inverse=True)[1]), key=lambda r: (r[0], r[2]))
    assert found == plain_runs(words) and len(found) > 5


def test_seeds_stay_few_in_one_word_a_hundred_thousand_times():
    words = np.zeros(100_000, np.int64)
    assert sum(len(lag) for _, lag, _, _ in repetition.seeds(words, 16)) < 20
    assert repetition.runs_of(words) == [(0, 100_000, 1)]


def test_nulls_ties_blanks_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(repetition, "BYTES_AT_ONCE", 300)
    texts = [
        None, "", " \t\n\x0b\x0c\r ", "one", "ab " * 30, "é ü " * 24, "a\x1cb " * 24, "a\u0085b  " * 23,
        "x y z " * 8, "x y z " * 7 + "x y", "p " * 40 + "q " * 40, "r s " * 12 + "mid " + "t u " * 12, "w" * 5000,
    ]
    rows = [(k if k != 3 else None, t, "mine", 1) for k, t in enumerate(texts)] + [(4, texts[4], "mine", 2), (4, "other", "mine", 3)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, runs string, start int")
    got = [(r["doc_id"], *(r[c] for c in COLUMNS)) for r in repetition.digest(repetition.found(documents)).collect()]
    assert sorted(got, key=repr) == sorted(((i, *plain_digest(i, t, plant=False)) for i, t, _, _ in rows), key=repr)
    planted = repetition.digest(repetition.found(repetition.planted(documents.where("doc_id is not null"))))
    got = [(r["doc_id"], *(r[c] for c in COLUMNS)) for r in planted.collect()]
    assert sorted(got, key=repr) == sorted(((i, *plain_digest(i, t)) for i, t, _, _ in rows if i is not None), key=repr)
    nothing = repetition.digest(repetition.found(repetition.planted(documents.limit(0))))
    assert nothing.count() == 0 and nothing.columns == ["doc_id", *COLUMNS]
    assert repetition.planted(documents.where("doc_id is null")).first()["text"] == "one"
