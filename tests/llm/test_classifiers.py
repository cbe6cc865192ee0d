"""Quality and toxicity on held-out labels, their language model against a plain one, and odd tables."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from folioflow.llm import neighbours, toxicity
from folioflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


@pytest.mark.parametrize(("query", "label", "by", "out", "recall", "false"), [("op6_neighbour_vote", "quality", 3, 1, 0.97, 0.05), ("op8_kneser_ney", "toxic", 4, 2, 0.75, 0.02)])
def test_held_out_labels(spark, query, label, by, out, recall, false):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = QUERIES[query](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    hits = Counter()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % by == out)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= (0.5 if by == 3 else 0.3))
        if r["held_out"] and r["doc_id"] in labels:
            hits[labels[r["doc_id"]], r["predicted"]] += 1
    assert hits[1, 1] >= recall * (hits[1, 0] + hits[1, 1])
    assert hits[0, 1] <= false * (hits[0, 0] + hits[0, 1])


def test_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    for module, label, (by, out) in ((neighbours, "quality", (3, 1)), (toxicity, "toxic", (4, 2))):
        turned = labels.selectExpr("doc_id", f"if(pmod(crc32(cast(cast(doc_id as string) as binary)), {by}) = {out}, 1 - {label}, {label}) as {label}")
        a, b = (sorted((r["doc_id"], r["score"]) for r in module.scored(docs, x).collect()) for x in (labels, turned))
        assert a == b


def test_language_model_agrees_with_plain_counts():
    """Small vocabularies have no two grams in one slot, so the tables hold the plain counts."""
    words = {0: Counter({b"the": 5, b"thin": 2}), 1: Counter({b"thug": 3, b"the": 1})}
    cells, marks = np.zeros(toxicity.CELLS, np.float32), []
    for kind, own in words.items():
        at, sums, mark = toxicity.class_counts(list(own), np.array(list(own.values())), kind)
        cells[at] = sums
        marks.append(mark)
    marks.append(toxicity.shared_marks([b"the", b"thin", b"thug", b"other"]))
    at, n = np.unique(np.unique(np.concatenate(marks)) >> 32, return_counts=True)
    cells[at] = n

    def grams(word, order):
        signs = b"\x01" * 6 + word + b"\x02"
        return [(signs[i - order + 1 : i], signs[i : i + 1]) for i in range(6, len(signs))]

    def plain(word):
        seen = {(o, k): Counter() for o in (6, 4) for k in (0, 1)}
        for k, own in words.items():
            for w, c in own.items():
                for o in (6, 4):
                    for g in grams(w, o):
                        seen[o, k][g] += c
        longer = {(a, b) for w in (b"the", b"thin", b"thug", b"other") for a, b in grams(w, 4)}
        before = Counter((a[1:], b) for a, b in longer)
        total, D, T = [0.0, 0.0], toxicity.DISCOUNT, toxicity.TRUST
        for (c3, s), (c4, _), (c6, _) in zip(grams(word, 3), grams(word, 4), grams(word, 6)):
            n = sum(v for (c, _), v in before.items() if c == c3)
            kinds = sum(c == c3 for c, _ in before)
            p = max((max(before[c3, s] - D, 0) + D * kinds / 256) / n, 1e-6) if n else 1 / 256
            for o, c in ((4, c4), (6, c6)):
                per = [{x[1]: v for x, v in seen[o, k].items() if x[0] == c} for k in (0, 1)]
                n = sum(map(sum, (d.values() for d in per)))
                if n:
                    own = max(sum(d.get(s, 0) for d in per) - D, 0)
                    p = (own + D * max(map(len, per)) * p) / n
            for k in (0, 1):
                own = max(per[k].get(s, 0) - D, 0) + (D * len(per[k]) + T) * p
                total[k] += math.log(max(own / (sum(per[k].values()) + T), 1e-9))
        return total[1] - total[0]

    found = toxicity.Models(cells).evidence([b"the", b"thug", b"thin", b"zebra", b"other", b"thu"])
    assert found == pytest.approx([plain(w) for w in (b"the", b"thug", b"thin", b"zebra", b"other", b"thu")], rel=1e-4, abs=1e-5)
    assert found[1] > 0.1 > -0.01 > found[2]


def test_voters_agree_with_all_distances():
    draw = np.random.default_rng(2)
    counts = draw.poisson(0.3, (300, neighbours.TERMS)).astype(np.float32)
    labels = (draw.random(300) < 0.5).astype(float)
    idf = np.ones(neighbours.TERMS, np.float32)
    voters = neighbours.Voters.fitted(counts, labels, idf)
    space = neighbours._unit(neighbours._weighed(counts, idf) @ voters.axes)
    for row in range(5):
        near = sorted(((float(space[row] @ v), k) for k, v in enumerate(voters.vectors)), reverse=True)[: neighbours.NEIGHBOURS]
        wanted = sum(max(s, 1e-6) ** 4 * labels[k] for s, k in near) / sum(max(s, 1e-6) ** 4 for s, k in near)
        assert voters(counts[row : row + 1])[0] == pytest.approx(wanted, rel=1e-3)


@pytest.mark.parametrize(("module", "label"), [(neighbours, "quality"), (toxicity, "toxic")])
def test_odd_tables(spark, module, label):
    rows = [(1, "good plain text here", "e"), (2, None, None), (3, "", ""), (None, "some text", "e"), (1, "good plain text here", "e"), (4, "long " * 50_000, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string").selectExpr("*", f"1 as {label}", "2 as value", "3 as score")
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    some = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1), (4, 0), (9, 1)], f"doc_id long, {label} int")
    for labels in (none, some):
        got = module.scored(docs, labels)
        assert got.columns == ["doc_id", "held_out", "score", "predicted"]
        found = got.collect()
        assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in rows)
        assert all(0 <= r["score"] <= 1 for r in found)
    assert module.scored(docs.limit(0), some).count() == 0


def test_toxicity_calibrates_on_every_row_without_collecting_them(spark):
    import numpy as np

    from folioflow.llm import toxicity

    rows = spark.range(20_000).selectExpr("cast(id % 200 as double) / 100 - 1 as value", "cast(id % 7 = 0 or id % 200 > 120 as int) as kind")
    line = toxicity.calibrated(toxicity.Models(np.zeros(0, np.float32)), rows)
    data = rows.toPandas()
    odds = 1 / (1 + np.exp(-(line.slope * data["value"] + line.shift)))
    # At the maximum of the likelihood what is left over is 0, but for the light ridge.
    assert abs((data["kind"] - odds).sum()) < 0.01 and abs(((data["kind"] - odds) * data["value"]).sum()) < 0.1


def test_toxicity_counts_every_text_once(spark):
    """One pass over all texts fills both classes' tables and the shared ones; a second one calibrates."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [(i, "foul thug" if i % 3 == 0 else "fine words here") for i in range(60)] + [(None, "fine foul"), (7, "once more"), (90, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").mapInArrow(seen, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(40)], "doc_id long, toxic int")
    models = toxicity.trained(docs, labels)
    assert read.value == 2 * len(rows)

    taught = {r["doc_id"]: r["kind"] for r in toxicity.training_labels(labels, "toxic", (4, 2)).collect()}
    cells, marks = np.zeros(toxicity.CELLS, np.float32), [toxicity.shared_marks(list({w for _, t in rows for w in toxicity.words_of((t or "").encode())}))]
    for kind in (0, 1):
        words = Counter(w for i, t in rows if taught.get(i) == kind for w in toxicity.words_of(t.encode()))
        at, sums, mark = toxicity.class_counts(list(words), np.array(list(words.values())), kind)
        cells[at] = sums
        marks.append(mark)
    at, n = np.unique(np.unique(np.concatenate(marks)) >> 32, return_counts=True)
    cells[at] = n
    assert (models.cells == cells).all()
