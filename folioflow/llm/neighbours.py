"""Quality of a text by a vote of its nearest labelled neighbours in a latent-semantic space."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import frugal

#: Labelled rows used at most: those with the least hash of their id.
SAMPLE = 4096
#: Counters for words, for the shapes of words, and for what shows in the order of words and lines.
WORDS, SHAPES, ORDER = 1024, 256, 12
TERMS = WORDS + SHAPES + ORDER
#: How much each kind of term counts in a vector.
SHARES = ((0, WORDS, 0.5), (WORDS, WORDS + SHAPES, 1.0), (WORDS + SHAPES, TERMS, 1.0))
DIMENSIONS = 48
NEIGHBOURS = 24
_REMEMBERED = 300_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _kind(byte: int) -> int:
    if 97 <= byte <= 122 or byte >= 128:
        return 0
    if 65 <= byte <= 90:
        return 1
    return 2 if 48 <= byte <= 57 else byte


class Terms:
    """Counts of the terms of a text."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def _code(self, word: bytes) -> int:
        """The word's counter and its shape's, in one number. The shape is the case of the word, its
        last two signs, whether it is long, and how it starts."""
        shape = bytes((_kind(word[0]) & 255, _kind(word[-1]) & 255, _kind(word[-2]) & 255 if len(word) > 1 else 0))
        shape += b"U" if word.isupper() and len(word) > 1 else b"L"
        shape += bytes((min(len(word), 40) // 10,))
        return zlib.crc32(word.translate(_LOWER)) % WORDS * SHAPES + zlib.crc32(shape) % SHAPES

    def __call__(self, text: bytes) -> np.ndarray:
        out = np.zeros(TERMS, np.float32)
        words = text.split()
        if not words:
            out[TERMS - 1] = 1
            return out
        known = self.known
        if len(known) > _REMEMBERED:
            known = self.known = {}
        codes = [known.get(w, -1) for w in words]
        if min(codes) < 0:
            known.update((w, self._code(w)) for w, c in zip(words, codes) if c < 0)
            codes = [known[w] for w in words]
        found = np.array(codes)
        out[:WORDS] = np.bincount(found // SHAPES, minlength=WORDS)
        out[WORDS : WORDS + SHAPES] = np.bincount(found % SHAPES, minlength=SHAPES)
        n = len(words)
        lines = [x for x in text.split(b"\n") if x]
        same = float((found[1:] == found[:-1]).mean()) if n > 1 else 0.0
        apart = len(set(lines)) / max(1, len(lines))
        fresh = min(1.0, len(set(codes)) / n * (1 + np.log1p(n) / 10))
        # In words for each document, like the other counts; both a sign and its absence are terms.
        for k, share in enumerate((same, 1 - apart, 1 - fresh, min(1.0, 20 / n), min(1.0, n / 5000))):
            out[WORDS + SHAPES + 2 * k] = n * share
            out[WORDS + SHAPES + 2 * k + 1] = n * (1 - share)
        return out


def _weighed(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """tf-idf with square-root counts; every kind of term has length one times its share."""
    out = np.sqrt(counts) * idf
    for a, b, share in SHARES:
        length = np.linalg.norm(out[:, a:b], axis=1, keepdims=True)
        out[:, a:b] *= share / np.maximum(length, 1e-9)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


@dataclass(frozen=True)
class Voters:
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @classmethod
    def fitted(cls, counts: np.ndarray, labels: np.ndarray, idf: np.ndarray, seed: int = 5) -> Voters:
        """Axes by randomised singular value decomposition of the labelled rows."""
        if not len(counts):
            return cls(idf, np.zeros((TERMS, 0), np.float32), np.zeros((0, 0), np.float32), labels)
        rows = _weighed(counts, idf)
        size = min(DIMENSIONS, len(rows))
        probe = rows @ np.random.default_rng(seed).standard_normal((TERMS, size + 8)).astype(np.float32)
        for _ in range(3):
            probe, _ = np.linalg.qr(rows @ (rows.T @ probe))
        _, _, axes = np.linalg.svd(probe.T @ rows, full_matrices=False)
        axes = axes[:size].T.astype(np.float32)
        return cls(idf, axes, _unit(rows @ axes).astype(np.float32), labels.astype(np.float32))

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled rows, by cosine to the fourth power."""
        if not len(self.vectors):
            return np.full(len(counts), 0.5)
        near = _unit(_weighed(counts, self.idf) @ self.axes) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        who = np.argpartition(near, -k, axis=1)[:, -k:]
        weights = np.maximum(np.take_along_axis(near, who, axis=1), 1e-6).astype(float) ** 4
        return np.clip((weights * self.labels[who]).sum(1) / weights.sum(1), 0.0, 1.0)


def remainder(doc_id: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(by))


def _with_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def document_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each term occurs, over all texts: TERMS sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, sums, n = Terms(), np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for text in batch.column(1).cast(pa.binary()):
                sums += terms(text.as_py() or b"") > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1)), pa.array([*sums.tolist(), n])], ["term", "n"])

    rows = _with_text(docs).mapInArrow(frugal(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r["term"]: r["n"] for r in rows}
    return np.array([counts.get(k, 0) for k in range(TERMS)]), counts.get(TERMS, 0)


def sampled_labels(labels: DataFrame, label: str, fold: tuple[int, int], sample: int) -> DataFrame:
    """``doc_id``, ``label`` of at most ``sample`` documents outside the held-out fold: the mean label
    of a document, those with the least hash first."""
    by, out = fold
    return (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(remainder("doc_id", by) != out)
        .groupBy("doc_id")
        .agg(F.avg(label).cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )


def trained(docs: DataFrame, labels: DataFrame, label: str = "quality", fold: tuple[int, int] = (3, 1), sample: int = SAMPLE) -> Voters:
    """Voters from a bounded sample of the labelled documents; term weights from all documents."""
    found, n = document_counts(docs)
    idf = np.log((1 + n) / (1 + found)).astype(np.float32) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            rows = [terms(t.as_py() or b"").tobytes() for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.binary())], ["doc_id", "label", "terms"])

    # The sample is bounded, so it may be broadcast. Copies of an id stand for themselves.
    chosen = F.broadcast(sampled_labels(labels, label, fold, sample))
    rows = (
        _with_text(docs).join(chosen, "doc_id").select("doc_id", "text", "label")
        .mapInArrow(frugal(run), "doc_id long, label double, terms binary")
        .groupBy("doc_id").agg(F.first("label").alias("label"), F.min("terms").alias("terms"))
        .collect()
    )
    rows.sort(key=lambda r: r["doc_id"])
    counts = np.array([np.frombuffer(r["terms"], np.float32) for r in rows]).reshape(len(rows), TERMS)
    return Voters.fitted(counts, np.array([r["label"] for r in rows]), idf)


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", fold: tuple[int, int] = (3, 1), sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row of ``docs``.

    Labels outside the held-out fold teach; ids, labels and other columns are no input of a score.
    Null and empty texts have a score like any other. Repeated labels of a document are averaged, null
    labels don't count; without any label every score is 0.5. Repeated rows and null ids are kept; an
    empty table gives an empty one.
    """
    voters = trained(docs, labels, label, fold, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # blocks of documents against all voters
                part = batch.slice(at, 512)
                counts = np.array([terms(t.as_py() or b"") for t in part.column(1).cast(pa.binary())])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(voters(counts))], ["doc_id", "score"])

    by, out = fold
    return (
        _with_text(docs)
        .mapInArrow(frugal(run), "doc_id long, score double")
        .select("doc_id", (remainder("doc_id", by) == out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
    )
