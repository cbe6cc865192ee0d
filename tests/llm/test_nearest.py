"""Multiprobe hashing against brute force."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pytest

from folioflow.llm import nearest
from folioflow.llm.queries import QUERIES


def plain(rows: list[tuple[int, list[float]]], every: int = 100, k: int = 10) -> dict[int, list[tuple[float, int]]]:
    out = {}
    for q, x in rows:
        if q % every == 0:
            far = [(math.sqrt(sum((float(a) - float(b)) ** 2 for a, b in zip(x, y))), i) for i, y in rows if i != q]
            out[q] = sorted(far)[:k]
    return out


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_query_finds_nearly_all_neighbours(spark, folder):
    path = f"/root/testdata/{folder}"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()]
    wanted, found = plain(rows), {}
    for r in QUERIES["op1_multiprobe_hashing"](spark, path).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == set(wanted)
    hits = 0
    vectors = {i: np.array(x, dtype=float) for i, x in rows}
    for q, got in found.items():
        got.sort()
        assert [r for r, _, _ in got] == list(range(1, 11))
        assert [(s, i) for _, i, s in got] == sorted((s, i) for _, i, s in got)
        for _, i, s in got:
            assert s == pytest.approx(np.linalg.norm(vectors[q] - vectors[i]), abs=1e-12)
        hits += len({i for _, i, _ in got} & {i for _, i in wanted[q]})
    assert hits >= 0.9 * 10 * len(wanted)


def test_perturbations_come_in_the_order_of_their_score():
    place = np.array([0.1, 0.35, 0.8])
    def score(moves):
        return sum((place[k] if step < 0 else 1 - place[k]) ** 2 for k, step in moves)

    every = [((k, s),) for k in range(3) for s in (-1, 1)]
    every = [c for n in range(4) for c in combinations([m for (m,) in every], n) if len({k for k, _ in c}) == n]
    found = nearest.perturbations(place, 1000)
    assert len(found) == len(every) == 27
    assert [score(m) for m in found] == pytest.approx(sorted(score(m) for m in every))


def test_copies_ties_and_what_takes_no_part(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 3)  # every bucket is shared out
    draw = np.random.default_rng(1)
    rows = [(k, draw.standard_normal(3).tolist()) for k in range(60)]
    rows += [(k, [1.0, 2.0, 3.0]) for k in range(100, 160)]
    bad = [(200, None), (201, [0.0, 0.0, 0.0]), (300, [1.0, float("nan"), 2.0]), (202, [1.0, None, 2.0]), (203, [float("inf"), 1.0, 1.0]),
           (None, [1.0, 1.0, 1.0]), (204, [1.0]), (205, [])]
    vectors = spark.createDataFrame(rows + bad + rows[:5], "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "'a' as x")
    found = {}
    for r in nearest.neighbours(vectors).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {0, 100}
    assert [(i, s) for _, i, s in sorted(found[100])] == [(k, 0.0) for k in range(101, 111)]
    assert [i for _, i, _ in sorted(found[0])] == [i for _, i in plain(rows)[0]]


def test_few_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert nearest.neighbours(spark.createDataFrame([], schema)).count() == 0
    assert nearest.neighbours(spark.createDataFrame([(0, [1.0], 1)], schema)).count() == 0
    got = nearest.neighbours(spark.createDataFrame([(0, [1.0], 1), (5, [3.0], 1), (7, [2.0], 1)], schema)).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == [(0, 1, 7, 1.0), (0, 2, 5, 2.0)]


@pytest.mark.parametrize("total", [10**8, 10**4])
def test_probes_meet_the_recall_however_many_vectors_there_are(monkeypatch, total):
    """Coarser cells take over where the most probes allowed would miss neighbours."""
    monkeypatch.setattr(nearest, "MEASURED", 8)
    sample = np.random.default_rng(5).standard_normal((400, 64))
    hashes = nearest.fitted(sample, total)
    ids = nearest.bucket_ids(hashes.cells(sample)[0])
    met = [set() for _ in range(8)]
    for row, t, visited in nearest.probed(hashes, sample[:8]):
        met[row] |= set(np.flatnonzero(np.isin(ids[:, t], visited)).tolist())
    far = np.linalg.norm(sample[:8, None] - sample[None], axis=2)
    near = [set(np.argsort(far[q])[1:11].tolist()) for q in range(8)]
    assert hashes.probes <= 4096
    assert sum(len(a & b) for a, b in zip(met, near)) >= 0.95 * 80
