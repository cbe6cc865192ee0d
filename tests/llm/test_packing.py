"""Tokens and packing: an exact round trip, and how full sequences are."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from folioflow.llm import packing
from folioflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, "a.b, c. ,.", "|| a| |b <|endoftext|>. x<|startoftext|>", "x., y,. .", "é. É, İSTANBUL ΟΔΟΣ Σ", "x ́y é\ńz",
    "a b　c\x1cd\x85f", "it's WE'LL 'S 12 3x", "가 가", " \t\n", "word " * 9000,
]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def ids_of(plain, text):
    return [*plain.encode(text or "", add_special_tokens=False).ids, 1]


def test_query_agrees_with_the_tokenizer(spark, plain):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op10_residual_packing"](spark, FOLDER).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(docs)
    for doc_id, own in pieces.items():
        ids = ids_of(plain, docs[doc_id])
        wanted = [
            (k, at, len(ids[at : at + 4096]), zlib.crc32(np.array(ids[at : at + 4096], "<u4").tobytes()))
            for k, at in enumerate(range(0, len(ids), 4096))
        ]
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in own) == wanted
    check_places(rows)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= 1.03 * -(-total // 4096) + 1


def check_places(rows, capacity=4096):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity


def test_encoder_on_odd_texts(plain, monkeypatch):
    monkeypatch.setattr(packing, "_REMEMBERED", 3)  # forgets all the time
    encode = packing._Encoder(PATH)
    for _ in range(2):
        for text in ODD:
            got, _ = encode(pa.array([text], pa.string()))
            assert got.tolist() == ids_of(plain, text)
    got, bounds = encode(pa.array(["left out", *ODD, "left out"], pa.string()).slice(1, len(ODD)))
    assert [got[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [ids_of(plain, text) for text in ODD]


def test_sequences_give_the_documents_back(spark, plain):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(ODD)] + [(None, "a b"), (2, "a.b, c. ,.")], "doc_id long, text string")
    rows = packing.sequences(docs.selectExpr("*", "1 as length", "2 as piece"), PATH).collect()
    pieces = []
    for r in rows:
        ids, at = np.frombuffer(r["ids"], "<u4").tolist(), 0
        assert sum(r["lengths"]) == len(ids) <= 4096
        for n in r["lengths"]:
            pieces.append(tuple(ids[at : at + n]))
            at += n
    wanted = []
    for text in [*ODD, "a b", "a.b, c. ,."]:
        ids = ids_of(plain, text)
        wanted += [tuple(ids[at : at + 4096]) for at in range(0, len(ids), 4096)]
    assert sorted(pieces) == sorted(wanted)


@pytest.mark.parametrize("group", [7, 40, 10_000])
def test_rounds_keep_every_item_and_fill_sequences(spark, group):
    draw = np.random.default_rng(3)
    lengths = np.concatenate([draw.integers(1, 101, 300), np.full(100, 60), np.full(50, 1), [100, 100]])
    items = spark.createDataFrame([(int(k), int(n), "x") for k, n in enumerate(lengths)], "item_id long, length long, bin_name string")
    rows = packing.packed(items, capacity=100, group=group).collect()
    assert sorted((r["item_id"], r["length"]) for r in rows) == list(enumerate(lengths.tolist()))
    check_places(rows, 100)
    bins = len({r["sequence_id"] for r in rows})
    best = packing.best_fit(lengths, 100)[2]
    assert bins <= 1.15 * len(best) + 1


def test_three_rounds_on_documents(spark, plain, monkeypatch):
    levels = []
    one_round = packing._round
    monkeypatch.setattr(packing, "_round", lambda items, tasks, level, capacity: levels.append(tasks) or one_round(items, tasks, level, capacity))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    rows = packing.packed_documents(docs, PATH, group=4).collect()
    assert len(levels) >= 3 and levels[-1] == 1 and levels == sorted(levels, reverse=True)
    wanted = sorted((r["doc_id"], n) for r in docs.collect() for n in [len(ids_of(plain, r["text"]))])
    by_doc = {}
    for r in rows:
        by_doc[r["doc_id"]] = by_doc.get(r["doc_id"], 0) + r["length"]
    assert sorted(by_doc.items()) == wanted
    check_places(rows)
    totals = {}
    for r in rows:
        totals[r["sequence_id"]] = totals.get(r["sequence_id"], 0) + r["length"]
    assert sum(2 * t <= 4096 for t in totals.values()) <= 1  # nothing is left that could be merged


@pytest.mark.parametrize("seed", range(5))
def test_bins_left_behind_would_merge_with_nothing(spark, seed):
    """The chosen bins of a round are packed into as many sequences fewer as all of its bins would be."""
    draw = np.random.default_rng(seed)
    big, small = draw.integers(51, 100, 400), draw.integers(1, 51, 30)
    rows = [(int(k), 0, int(n)) for k, n in enumerate([*big, *small])]
    step = spark.createDataFrame(rows, "bin long, shift long, total long")
    chosen = np.array([r["length"] for r in packing._underfull(step, 100).collect()])
    everything = np.array([n for _, _, n in rows])
    saved = len(everything) - len(packing.best_fit(everything, 100)[2])
    assert len(chosen) - len(packing.best_fit(chosen, 100)[2]) == saved > 0


def test_best_fit_takes_the_fullest_bin_that_fits():
    bins, offsets, filled = packing.best_fit(np.array([5, 6, 4, 3, 2]), 10)
    assert filled.tolist() == [10, 10] and bins.tolist() == [1, 0, 0, 1, 1] and offsets.tolist() == [0, 0, 6, 5, 8]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed_documents(docs, PATH).count() == 0
