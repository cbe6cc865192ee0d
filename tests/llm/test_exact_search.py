"""Top-k by inner product against all products."""

from __future__ import annotations

import math

import numpy as np
import pytest

from folioflow.llm import exact_search
from folioflow.llm.queries import QUERIES


def plain(rows: list[tuple[int, list[float]]], every: int = 20, k: int = 20) -> list[tuple]:
    known = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in {(i, tuple(v)): None for i, v in rows}]
    out = []
    for q, x in known:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in known if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def found(df) -> list[tuple]:
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


@pytest.fixture
def small(monkeypatch):
    """Many shards, leaves and shares on small tables."""
    for name, value in (("LEAF", 4), ("SHARD", 40), ("QUERIES", 3), ("TOGETHER", 2)):
        monkeypatch.setattr(exact_search, name, value)


def test_query_on_whole_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert found(QUERIES["op11_kd_trees"](spark, path)) == plain(rows)


@pytest.mark.parametrize("kind", ["normal", "clusters", "grid", "one axis"])
def test_many_shards_are_exact(spark, small, kind):
    draw = np.random.default_rng(11)
    rows = draw.normal(size=(700, 6))
    if kind == "clusters":
        rows = np.repeat(draw.normal(size=(7, 6)) * 5, 100, axis=0) + draw.normal(size=(700, 6)) * 0.01
    if kind == "grid":  # ties and copies everywhere
        rows = draw.integers(-1, 2, size=(700, 6)) / 64
    if kind == "one axis":
        rows = np.zeros((700, 6))
        rows[:, 2] = np.arange(700) % 9
    rows = [(k, r.tolist()) for k, r in enumerate(rows)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(exact_search.top(vectors, k=7)) == plain(rows, k=7)


def test_trees_are_cut_by_boxes_and_bars():
    draw = np.random.default_rng(3)
    points = (np.repeat(draw.normal(size=(16, 8)) * 400, 64, axis=0) + draw.normal(size=(1024, 8)) * 4).round()
    ids = np.arange(1024)
    parts = exact_search.leaves_of(points, 32)
    assert len(parts) == 32 and sorted(np.concatenate(parts).tolist()) == ids.tolist()
    tree = exact_search.Tree([points[p] for p in parts], [ids[p] for p in parts], np.float64)
    asked, own = points[::64], ids[::64]
    nothing = np.full(16, float(exact_search.NONE))
    who, score, met, visits = tree.search(asked, own, nothing, 5)
    assert visits < 16 * 32 / 4
    all_scores = asked @ points.T
    all_scores[np.arange(16), own] = -np.inf
    for q in range(16):
        wanted = sorted((-s, i) for i, s in enumerate(all_scores[q]))[:5]
        assert [(-s, i) for s, i in zip(score[who == q], met[who == q])] == wanted
    # With the k-th score brought along, only leaves that hold a match are opened.
    bars = np.array([score[who == q][-1] for q in range(16)])
    again = tree.search(asked, own, bars, 5)
    assert again[3] <= visits and (again[1] == score).all() and (again[2] == met).all()
    assert tree.search(asked, own, bars + 1e9, 5)[3] == 0


def test_nulls_copies_repeats_and_what_takes_no_part(spark, small):
    draw = np.random.default_rng(1)
    rows = [(k, draw.standard_normal(3).tolist()) for k in range(60)]
    rows += [(k, [1.0, 2.0, 3.0]) for k in range(100, 190)] + [(40, [9.0, 9.0, 9.0]), (-20, [0.0, 0.0, 0.0])]
    bad = [(200, None), (201, [0.0, None, 0.0]), (300, [1.0, float("nan"), 2.0]), (203, [float("inf"), 1.0, 1.0]),
           (None, [1.0, 1.0, 1.0]), (220, [1.0]), (205, [])]
    vectors = spark.createDataFrame(rows + bad + rows[:5], "vec_id long, embedding array<float>").selectExpr(
        "*", "1 as cell", "'a' as x", "2 as query"
    )
    rows = [(i, np.float32(v).tolist()) for i, v in rows]
    assert found(exact_search.top(vectors)) == plain(rows)


def test_few_and_large_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    assert found(exact_search.top(spark.createDataFrame([], schema))) == []
    assert found(exact_search.top(spark.createDataFrame([(0, [1.0]), (20, None)], schema))) == []
    rows = [(0, [1.0]), (5, [3.0]), (7, [2.0])]
    assert found(exact_search.top(spark.createDataFrame(rows, schema))) == [(0, 1, 5, 64 * 192), (0, 2, 7, 64 * 128)]
    # Too large for doubles, not for whole numbers.
    large = [(k, [2e6 + k / 64, -1e6 + k * 0.5, 7.0 * k]) for k in range(45)]
    assert found(exact_search.top(spark.createDataFrame(large, schema))) == plain(large)
    huge = exact_search.top(spark.createDataFrame([(0, [3e38, 1.0]), (1, [3e38, 1.0]), (2, [-3e38, 1.0])], schema))
    assert [(q, r, i) for q, r, i, _ in found(huge)] == [(0, 1, 1), (0, 2, 2)]
