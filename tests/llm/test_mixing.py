"""Pareto mixing against SQL and by its promises."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folioflow.llm import mixing
from folioflow.llm.queries import ORACLE, QUERIES
from tests.compare import difference, oracle

FOLDER = "/root/testdata/sf0.001"


def test_query_agrees_with_sql(spark):
    assert difference(QUERIES["op4_pareto_mixture"](spark, FOLDER), oracle(FOLDER), ORACLE["op4_pareto_mixture"]) is None


def plain_targets(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    out, left, open_ = {}, 1.5 * sum(sizes.values()), list(names)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not above:
            return out | share
        for s in above:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ = [s for s in open_ if s not in above]
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, None: 5, "": 7}, {"x": 3}, {"a": 0, "b": 0}, {"é": 5, "z": 50, "a": 500, "m": 0}])
def test_targets_are_those_of_resharing_again_and_again(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    assert found == pytest.approx(plain_targets(sizes))


def test_taken_words_nulls_repeats_and_copies(spark):
    rows = [(k, "w " * (1 + k % 17 + k % 4), ("a", "b", "c", None)[k % 4], "x", 0) for k in range(2000)]
    rows += [(None, None, None, None, None), (7, "", "", "x", 0), (8, "w w", "a", "x", 0), (8, "w w", "a", "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, part string, target long")
    found = mixing.mixture(docs).collect()
    assert len(found) == len(rows)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    taken, target = Counter(), {}
    for r in found:
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 2
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, mixing.mixture(docs.repartition(7)).collect()), key=str)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r["doc_id"], r["source"]] += len((r["text"] or "").split())
    wanted = Counter()
    for r, d in zip(sorted(found, key=lambda r: (r["doc_id"] or 0, r["size"])), sorted(rows, key=lambda d: (d[0] or 0, len((d[1] or "").split())))):
        wanted[d[0], d[2]] += r["taken"]
    assert +words == +wanted


def test_a_misfit_does_not_end_the_sampling(spark):
    draw = random.Random(5)
    rows = [(k, "w " * 30, "a") for k in range(300)] + [(1000, "w " * 10_000, "a")]
    rows += [(2000 + k, "w " * int(draw.paretovariate(0.7)), "b") for k in range(300)] + [(3000, "w " * 7, "b")] * 25
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    for seed in (11, 15):
        found = mixing.mixture(docs, seed).collect()
        for source in {r["source_size"] for r in found}:
            own = [r for r in found if r["source_size"] == source]
            missing = own[0]["target"] - sum(r["taken"] for r in own)
            single = [r["size"] for r in own if r["taken"] <= r["size"] * int(own[0]["target"] // source)]
            assert abs(missing) < max(1, min(single, default=1)) or abs(missing) < 25 * 7 == min(single) * 25


@pytest.mark.parametrize("walked, sorted_ranks", [(20_000, 100_000), (40, 100_000), (100, 3)])
def test_walking_down_the_order_document_by_document(spark, monkeypatch, walked, sorted_ranks):
    monkeypatch.setattr(mixing, "WALKED", walked)
    monkeypatch.setattr(mixing, "SORTED", sorted_ranks)
    monkeypatch.setattr(mixing, "CELLS", 8)
    draw = random.Random(8)
    sizes = [1 + int(20 * draw.paretovariate(1.2)) for _ in range(400)]
    rest = 0.4 * sum(sizes)
    ranked = spark.createDataFrame([("s", (k / 400, k, ""), n) for k, n in enumerate(sizes)], "_s string, _o struct<z:double,d:long,_t:string>, words long")
    rates = spark.createDataFrame([("s", 0.4, rest)], "_s string, part double, rest double")
    gap, taken = rest, set()
    for k, n in enumerate(sizes):
        if n <= gap:
            gap -= n
            taken.add(k)
    rounds = mixing._segments(ranked, rates)
    assert [r["gap"] for r in rounds.where("round > 0 and start is null").collect()] in ([pytest.approx(gap)], [])
    assert rounds.where("start is not null").count() > 1
    segments = rounds.where("round = 0 or start is not null").groupBy("_s").agg(F.array_sort(F.collect_list(F.struct("round", "start", "gap"))).alias("x"))
    found = ranked.join(segments, "_s").where(mixing._fits(F.col("x"), F.col("_o"), F.col("words")))
    assert {r["_o"]["d"] for r in found.collect()} == taken


def test_columns_with_the_names_of_inner_ones(spark):
    rows = [(k, "w " * (k % 9), "ab"[k % 2], k, "x", None, -k, "row") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _s long, _t string, _u double, size long, _row string")
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert set(map(tuple, mixed.collect())) <= set(map(tuple, docs.collect()))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mixture(docs).count() == 0 and mixing.mixed(docs).count() == 0
