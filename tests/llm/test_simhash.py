"""Covering SimHash against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from folioflow.llm import simhash
from folioflow.llm.components import components
from folioflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_fingerprint(text: str | None) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps: dict, radius: int = 4) -> dict:
    """Least key of each component, keys with their fingerprints given."""
    left, out = set(fps), {}
    while left:
        todo, seen = [left.pop()], set()
        while todo:
            a = todo.pop()
            seen.add(a)
            near = {b for b in left if (fps[a] ^ fps[b]).bit_count() <= radius}
            left -= near
            todo += near
        out |= dict.fromkeys(seen, min(seen))
    return out


def test_query_agrees_with_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    fps = {d: plain_fingerprint(t) for d, t in docs.items()}
    wanted = plain_components(fps)
    found = QUERIES["op3_covering_simhash"](spark, FOLDER).collect()
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found) == sorted(
        (d, f"{fps[d]:016x}", wanted[d]) for d in docs
    )


def test_masks_cover_every_pair_within_the_radius():
    masks, draw = simhash.covering_masks(4), random.Random(3)
    assert len(masks) == 31
    for _ in range(2000):
        flips = sum({1 << draw.randrange(64) for _ in range(4)})
        assert any(flips & m == 0 for m in masks)


@pytest.mark.parametrize("pairwise", [1, 3, 2048])
def test_links_lose_no_pair_in_buckets_of_any_size(spark, pairwise):
    """A chain, a dense group and strangers; with small limits most buckets go through midpoints."""
    draw = random.Random(5)
    values, at = set(), draw.getrandbits(64)
    for _ in range(30):
        at ^= sum({1 << draw.randrange(64) for _ in range(4)})
        values.add(at)
    for _ in range(60):
        values.add(at ^ sum({1 << draw.randrange(12) for _ in range(3)}))
    values |= {draw.getrandbits(64) for _ in range(100)}
    signed = {int(np.uint64(v).astype(np.int64)): v for v in values}
    wanted = plain_components(signed)
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), pairwise=pairwise)
    for e in edges.collect():
        assert ((signed[e["u"]] ^ signed[e["v"]]).bit_count()) <= 4
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    assert {v: roots.get(v, v) for v in signed} == wanted


def test_long_texts_are_voted_on_in_blocks():
    text = " ".join(f"w{i % 977}" for i in range(140_000))
    assert simhash.simhash(text.encode()) == plain_fingerprint(text)


def test_nulls_empties_repeats_and_clashing_names(spark):
    rows = [
        (5, None, "x", None, None), (3, "", "x", "s", 0), (3, "", "x", "s", 0), (None, " \n", None, None, None),
        (9, "One two", "x", "s", 7), (8, "one\tTWO", "x", "s", 7), (None, "alone here now", None, None, None),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, simhash.near_duplicates(docs.withColumnRenamed("lang", "fp")).collect()), key=str)
    zero, two, alone = (f"{plain_fingerprint(t):016x}" for t in ("", "one two", "alone here now"))
    assert got == sorted(
        [(5, zero, 3), (3, zero, 3), (3, zero, 3), (None, zero, 3), (9, two, 8), (8, two, 8), (None, alone, None)], key=str
    )
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"]) == [(3, ""), (8, "one\tTWO")]
    assert kept.count() == 3
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.one_of_each_group(docs.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(10, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {k: 10 for k in range(10, 61)} | {k: 100 for k in range(100, 160)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_different_texts_under_one_id_are_rows_of_their_own(spark):
    rows = [(1, "alpha beta gamma delta", 1), (1, "something else is said here", 2), (2, "ALPHA beta gamma delta", 3), (1, "alpha beta gamma delta", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id long").selectExpr("*", "7 as _key", "8 as _row", "9 as _k0")
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, "alpha beta gamma delta"), (1, "something else is said here")]
    assert all((r["_key"], r["_row"], r["_k0"]) == (7, 8, 9) for r in kept.collect())
