"""Codes of vectors against plain whole-number arithmetic."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from folioflow.llm import vector_codes
from folioflow.llm.queries import QUERIES


def plain(rows: list[tuple]) -> list[tuple]:
    """``rows``: id, vector, label; gives id, code, error, label error, digest of the codebooks."""
    kept = [(i, [math.floor(256 * float(x)) for x in v], label) for i, v, label in rows]
    kept = [(i, v + [0] * (-len(v) % 16), label) for i, v, label in kept]
    width = len(kept[0][1]) // 16

    def cut(v):
        return [v[j * width : (j + 1) * width] for j in range(16)]

    ordered = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[list(cut(v)[j]) for _, v, _ in ordered[:64]] for j in range(16)]

    def assign():
        out = []
        for _, v, _ in kept:
            found = []
            for j, part in enumerate(cut(v)):
                far = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in books[j]]
                found.append((far.index(min(far)), min(far)))
            out.append(found)
        return out

    for _ in range(2):
        codes = assign()
        for j in range(16):
            for e in range(len(books[j])):
                mine = [cut(v)[j] for (_, v, _), c in zip(kept, codes) if c[j][0] == e]
                if mine:
                    books[j][e] = [sum(column) // len(mine) for column in zip(*mine)]
    spelt = ",".join(str(c) for book in books for entry in book for c in entry)
    sha = hashlib.sha256(spelt.encode()).hexdigest()
    codes = assign()
    errors = [sum(d for _, d in c) for c in codes]
    return [
        (i, "".join(f"{e:02x}" for e, _ in c), error, sum(x for x, (_, _, m) in zip(errors, kept) if m == label), sha)
        for (i, _, label), c, error in zip(kept, codes, errors)
    ]


def test_query_on_whole_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = QUERIES["op12_integer_codes"](spark, path).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert sorted(tuple(r) for r in found.collect()) == sorted(plain(rows))


@pytest.mark.parametrize("width", [1, 2, 3, 4, 7, 48])
def test_transform_and_elimination_are_exact(width):
    draw = np.random.default_rng(width)
    parts, entries = draw.integers(-900, 900, (300, width)), draw.integers(-900, 900, (64, width))
    entries[40:] = entries[:24]  # ties
    a, b = vector_codes.transform(parts), vector_codes.transform(entries)
    size = a.shape[1]
    far = ((parts[:, None] - entries[None]) ** 2).sum(-1)
    assert (((a[:, None] - b[None]) ** 2).sum(-1) == size * far).all()
    code, error = vector_codes._nearest(a, b)
    assert (code == far.argmin(1)).all() and (error == far.min(1)).all()


@pytest.mark.parametrize("size", [1, 2, 4, 16, 64])
def test_sequency_counts_changes_of_sign(size):
    signs = vector_codes.transform(np.eye(size, dtype=np.int64)).T
    assert [int((row[1:] != row[:-1]).sum()) for row in signs] == list(range(size))


def test_largest_components_keep_within_63_bits():
    for width in (1, 4, 5, 48, 256):
        most = vector_codes.largest_component(width)
        ends = np.array([[most] * width, [-most] * width])
        a = vector_codes.transform(ends)
        code, error = vector_codes._nearest(a[:1], a[1:])
        assert error[0] == width * (2 * most) ** 2 and error[0] * a.shape[1] < 2**63


def test_nulls_ties_repeats_and_what_takes_no_part(spark, monkeypatch):
    draw = np.random.default_rng(2)
    rows = [(k, draw.normal(size=20).tolist(), k % 3 if k % 4 else None) for k in range(90)]
    rows += [(k, [0.5] * 20, 1) for k in range(90, 130)] + rows[:7] + [(3, [-0.001] * 20, 2), (None, [0.25] * 20, None)]
    bad = [(200, None, 1), (201, [0.0] * 19 + [None], 1), (1, [float("nan")] + [0.0] * 19, 1), (2, [float("inf")] * 20, 1),
           (203, [1.0], 1), (204, [], None)]
    schema = "vec_id long, embedding array<double>, label int, code string, part int, x int"
    vectors = spark.createDataFrame([(*r, "mine", 1, 2) for r in rows + bad], schema)
    wanted = sorted(plain(rows), key=repr)
    assert sorted((tuple(r) for r in vector_codes.digest(vectors).collect()), key=repr) == wanted
    # Too many labels to be sent to every task.
    monkeypatch.setattr(vector_codes, "broadcast_if_small", lambda df: df)
    assert sorted((tuple(r) for r in vector_codes.digest(vectors).collect()), key=repr) == wanted


def test_few_rows_and_no_label(spark):
    schema = "vec_id long, embedding array<float>"
    assert vector_codes.digest(spark.createDataFrame([], schema)).count() == 0
    assert vector_codes.digest(spark.createDataFrame([(1, None), (2, []), (3, [float("nan")])], schema)).count() == 0
    rows = [(5, [1.5, -2.25]), (4, [1.0, 8.0]), (4, [1.0, 8.0])]
    got = vector_codes.digest(spark.createDataFrame(rows, schema)).collect()
    assert sorted(tuple(r) for r in got) == sorted(plain([(*r, None) for r in rows]))
    huge = vector_codes.digest(spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 1.0])], schema)).collect()
    assert sorted((r["vec_id"], r["error"]) for r in huge) == [(1, 0), (2, 0)]
