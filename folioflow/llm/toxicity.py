"""Toxicity by two Kneser-Ney language models: of toxic and of ordinary text.

Both read words as strings of signs and predict each sign from those before it in the word, so that
parts of words carry over to words never seen. The longest contexts count, for each class, the words of
its labelled documents; what is rare there falls back on shorter contexts of the class and in the end
on continuation counts that both classes share and that come from the words of all documents. A word
of which neither class knows anything scores alike in both.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import frugal, staged
from folioflow.llm.neighbours import remainder

#: Signs that a class's counts look at and the slots of their tables, the longest first.
ORDERS = ((6, 1 << 19), (4, 1 << 18))
#: The order whose counts both classes share.
SHARED, SHARED_SLOTS = 3, 1 << 18
DISCOUNT = 0.75
#: So many signs of a context count as seen in the common text before a class's own count for more.
TRUST = 60.0
#: A toxic text is taken for ordinary text in which this share of the words is toxic.
SHARE = 0.01
#: One in so many labelled documents is kept from the models that calibrate, all on what these have not seen;
#: the models that score count every labelled document.
KEPT_APART = 5
#: Labels of so many bytes are sent to every task; beyond, they are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
_WORDS_HELD = 200_000
#: Tag of texts without a label; that of others says their class and whether they are apart.
_UNLABELLED = 4
_PAD, _END = 1, 2
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_EDGES = b".,;:!?\"'()[]{}<>|*#$%&"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Signs:
    """Words as one row of signs, each word after enough padding that no context reaches another."""

    def __init__(self, words: list[bytes]) -> None:
        pad = bytes([_PAD]) * ORDERS[0][0]
        bare = [w.strip(_EDGES) or b"." for w in words]
        flat = pad + (bytes([_END]) + pad).join(bare) + bytes([_END])
        self.signs = np.frombuffer(flat, np.uint8).astype(np.uint64)
        lengths = np.array([len(w) + 1 for w in bare])
        self.lengths = lengths
        self.starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        first = np.repeat(np.cumsum(lengths + len(pad)) - lengths, lengths)
        self.places = first + np.arange(lengths.sum()) - np.repeat(self.starts, lengths)

    def gram(self, longest: int, shortest: int, salt: int) -> np.ndarray:
        """A hash of the signs from ``longest`` to ``shortest`` places back, at every sign."""
        out = np.full(len(self.places), salt + 1, np.uint64)
        factor = np.uint64(0x100000001B3)
        for back in range(longest, shortest - 1, -1):
            out = out * factor + self.signs[self.places - back] + np.uint64(1)
        return _mixed(out)

    def context(self, order: int) -> np.ndarray:
        return self.gram(order - 1, 1, order)

    def whole(self, order: int) -> np.ndarray:
        return self.gram(order - 1, 0, order + 100)


def _slot(hashes: np.ndarray, slots: int) -> np.ndarray:
    return (hashes % np.uint64(slots)).astype(np.int64)


#: Tables side by side in one numbering of cells: name, class, order, slots.
TABLES = [(name, kind, order, slots) for name in ("context", "whole", "follow") for kind in (0, 1) for order, slots in ORDERS]
TABLES += [("before", 2, SHARED, SHARED_SLOTS), ("sums", 2, SHARED, SHARED_SLOTS), ("kinds", 2, SHARED, SHARED_SLOTS)]
_FIRST = dict(zip([t[:3] for t in TABLES], np.cumsum([0] + [t[3] for t in TABLES]).tolist()))
CELLS = sum(t[3] for t in TABLES)


def class_counts(words: list[bytes], counts: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells and their sums from a class's words, and (cell, gram) marks of what counts once."""
    signs, cells, marks = Signs(words), [], []
    weights = np.repeat(counts, signs.lengths)
    for order, slots in ORDERS:
        context, whole = signs.context(order), signs.whole(order)
        cells += [_FIRST["context", kind, order] + _slot(context, slots), _FIRST["whole", kind, order] + _slot(whole, slots)]
        marks.append(_marks(_FIRST["follow", kind, order] + _slot(context, slots), whole))
    at, inverse = np.unique(np.concatenate(cells), return_inverse=True)
    sums = np.bincount(inverse, np.tile(weights, len(cells)))
    return at, sums.astype(np.int64), np.unique(np.concatenate(marks))


def shared_marks(words: list[bytes]) -> np.ndarray:
    """Marks of all words for the shared continuation counts: a gram counts once for each sign before it."""
    signs = Signs(words)
    longer, whole = signs.whole(SHARED + 1), signs.whole(SHARED)
    context = signs.context(SHARED)
    return np.unique(
        np.concatenate(
            [
                _marks(_FIRST["before", 2, SHARED] + _slot(whole, SHARED_SLOTS), longer),
                _marks(_FIRST["sums", 2, SHARED] + _slot(context, SHARED_SLOTS), longer),
                _marks(_FIRST["kinds", 2, SHARED] + _slot(context, SHARED_SLOTS), whole),
            ]
        )
    )


def _marks(cells: np.ndarray, grams: np.ndarray) -> np.ndarray:
    return cells << 32 | (grams >> np.uint64(32)).astype(np.int64)


@dataclass
class Models:
    """Both language models in tables of fixed size, and the line that turns their difference into a score."""

    cells: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def __post_init__(self) -> None:
        self.known: dict[bytes, float] = {}

    def _table(self, name: str, kind: int, order: int, slots: int) -> np.ndarray:
        first = _FIRST[name, kind, order]
        return self.cells[first : first + slots]

    def evidence(self, words: list[bytes]) -> np.ndarray:
        """For each word: log-likelihood as toxic text less that as ordinary text."""
        signs = Signs(words)
        context, whole = _slot(signs.context(SHARED), SHARED_SLOTS), _slot(signs.whole(SHARED), SHARED_SLOTS)
        sums = self._table("sums", 2, SHARED, SHARED_SLOTS)[context]
        kinds = self._table("kinds", 2, SHARED, SHARED_SLOTS)[context]
        before = self._table("before", 2, SHARED, SHARED_SLOTS)[whole]
        shared = (np.maximum(before - DISCOUNT, 0) + DISCOUNT * kinds / 256) / np.maximum(sums, 1)
        shared = np.where(sums > 0, np.maximum(shared, 1e-6), 1 / 256)
        common, found = shared, None
        for order, slots in reversed(ORDERS):
            found = {}
            context, whole = _slot(signs.context(order), slots), _slot(signs.whole(order), slots)
            for name, at in (("context", context), ("whole", whole), ("follow", context)):
                found[name] = [self._table(name, kind, order, slots)[at] for kind in (0, 1)]
            n = found["context"][0] + found["context"][1]
            own = np.maximum(found["whole"][0] + found["whole"][1] - DISCOUNT, 0)
            back = DISCOUNT * np.maximum(*found["follow"])
            common = np.where(n > 0, (own + back * common) / np.maximum(n, 1), common)
        both = []
        for n, whole, follow in zip(found["context"], found["whole"], found["follow"]):
            own = np.maximum(whole - DISCOUNT, 0) + (DISCOUNT * follow + TRUST) * common
            both.append(np.log(np.clip(own / (n + TRUST), 1e-9, None)))
        return np.add.reduceat(both[1] - both[0], signs.starts)

    def difference(self, texts: list[bytes]) -> np.ndarray:
        """Log-likelihood as toxic text less that as ordinary text, over the root of the length.

        Toxic text is a mixture: each word is toxic with probability ``SHARE``, else ordinary. Texts
        without words have no difference.
        """
        if len(self.known) > _WORDS_HELD:
            self.known = {}
        split = [words_of(t) for t in texts]
        new = list({w: None for words in split for w in words if w not in self.known})
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            gain = np.log1p(SHARE * np.expm1(np.clip(self.evidence(some), -9, 9)))
            self.known.update(zip(some, gain.tolist()))
        known = self.known
        return np.array([sum([known[w] for w in words]) / max(1, len(words)) ** 0.5 for words in split])


def calibrated(models: Models, rows: DataFrame) -> Models:
    """Slope and shift by logistic regression on the scaled difference (``value``, ``kind``), with a light ridge.

    Every step of Newton's method is one aggregate over all rows: five sums reach the driver.
    """
    kinds = rows.agg(F.min("kind"), F.max("kind"), F.avg("kind"), F.stddev_pop("value")).first()
    if kinds[0] is None or kinds[0] == kinds[1]:
        share = min(max(float(kinds[2] or 0), 0.01), 0.99)
        return Models(models.cells, 0.0, float(np.log(share / (1 - share))))
    scale = kinds[3] or 1.0
    x, w = F.col("value") / scale, np.zeros(2)
    for _ in range(50):
        score = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x * float(w[0]) + float(w[1])))
        p = 1 / (1 + F.exp(-score))
        weight, rest = p * (1 - p) + 1e-9, F.col("kind") - p
        a, b, c, d, e = rows.agg(F.sum(weight * x * x), F.sum(weight * x), F.sum(weight), F.sum(rest * x), F.sum(rest)).first()
        ridge = np.array([0.01, 0.0])
        step = np.linalg.solve(np.array([[a, b], [b, c]]) + np.diag(ridge + 1e-9), np.array([d, e]) - ridge * w)
        w = w + step
        # Sums of parts differ in their last digits from run to run; what is left of that is rounded off.
        if np.abs(step).max() < 1e-8:
            break
    return Models(models.cells, float(f"{w[0] / scale:.9g}"), float(f"{w[1]:.9g}"))


def _with_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def training_labels(labels: DataFrame, label: str, fold: tuple[int, int]) -> DataFrame:
    """``doc_id``, ``kind`` (0 or 1) of all labelled documents outside the held-out fold."""
    by, out = fold
    return (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(remainder("doc_id", by) != out)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg(label) >= 0.5).cast("int").alias("kind"))
    )


def _labelled(docs: DataFrame, known: DataFrame, how: str = "inner") -> DataFrame:
    if known.count() * 16 <= BROADCAST_BYTES:
        known = F.broadcast(known)
    return _with_text(docs).join(known, "doc_id", how)


def _gathered(batches: Iterator[pa.RecordBatch], flush) -> Iterator[pa.RecordBatch]:
    """Count the words of the batches' texts by tag; hand them on together whenever many are held."""
    held: dict[int, Counter] = {}
    for batch in batches:
        tags = batch.column(1).to_pylist()
        for text, tag in zip(batch.column(0).cast(pa.binary()), tags):
            held.setdefault(tag, Counter()).update(words_of(text.as_py() or b""))
        if sum(map(len, held.values())) > _WORDS_HELD:
            yield from flush(held)
            held = {}
    yield from flush(held)


def _rows(cells: np.ndarray, sums: np.ndarray | None, apart: int) -> pa.RecordBatch:
    n = pa.array(sums) if sums is not None else pa.nulls(len(cells), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(cells), n, pa.array(np.full(len(cells), apart, np.int32))], ["cell", "n", "apart"])


def language_models(texts: DataFrame) -> tuple[Models, Models]:
    """Tables from all words of all labelled texts, and the shared ones from all words of all texts; and the same
    without the labelled texts that are ``apart``.

    ``texts`` holds all texts with ``kind`` and ``apart``, null where there is no label, so that every text is read and
    counted once. Tasks send distinct cells, which are summed or made distinct by a shuffle; no more than ``CELLS``
    pairs of sums reach the driver, whatever the input.
    """

    def counted(held: dict[int, Counter]) -> Iterator[pa.RecordBatch]:
        for tag, words in held.items():
            if words and tag != _UNLABELLED:
                kind, apart = tag // 2, tag % 2
                cells, sums, marks = class_counts(list(words), np.fromiter(words.values(), np.int64, len(words)), kind)
                yield _rows(cells, sums, apart)
                yield _rows(marks, None, apart)
        names = list(set().union(*held.values()))
        if names:
            yield _rows(shared_marks(names), None, 0)

    tag = F.coalesce(F.col("kind") * 2 + F.col("apart").cast("int"), F.lit(_UNLABELLED)).alias("tag")
    sent = texts.select("text", tag).mapInArrow(frugal(lambda b: _gathered(b, counted)), "cell long, n long, apart int")
    taught = F.when(F.col("apart") == 0, F.col("n")).otherwise(0)
    # Sums are numbered by their cell, marks by more, so neither is taken for the other. A mark that some text not
    # apart has counts for both.
    once = sent.groupBy("cell").agg(F.sum("n").alias("n"), F.sum(taught).alias("taught"), F.min("apart").alias("apart"))
    mark = F.col("n").isNull()
    found = (
        once.groupBy(F.when(mark, F.shiftright("cell", 32)).otherwise(F.col("cell")).alias("cell"))
        .agg(
            F.sum(F.coalesce("n", F.lit(1))).alias("n"),
            F.sum(F.when(mark, (F.col("apart") == 0).cast("long")).otherwise(F.col("taught"))).alias("taught"),
        )
        .select(F.col("cell").cast("int"), F.col("n").cast("float"), F.col("taught").cast("float"))
        .toArrow()
    )

    def tables(name: str) -> Models:
        cells = np.zeros(CELLS, np.float32)
        cells[found.column("cell").to_numpy()] = found.column(name).to_numpy()
        return Models(cells)

    return tables("n"), tables("taught")


def trained(docs: DataFrame, labels: DataFrame, label: str = "toxic", fold: tuple[int, int] = (4, 2)) -> Models:
    """Language models from all labelled rows and all texts; the score's line from all labelled rows kept apart,
    by models that don't count these."""
    known = training_labels(labels, label, fold).withColumn("apart", F.pmod(F.xxhash64("doc_id"), F.lit(KEPT_APART)) == 0)
    models, without = language_models(_labelled(docs, known, "left"))
    apart = _labelled(docs, known.where("apart")).select("doc_id", "text", "kind")
    rows = (
        apart.mapInArrow(frugal(_scoring(without, "kind")), "doc_id long, value double, kind int")
        .groupBy("doc_id").agg(F.min("value").alias("value"), F.first("kind").alias("kind"))
    )
    line = calibrated(without, staged(rows, "calibration"))
    return Models(models.cells, line.slope, line.shift)


def _scoring(models: Models, extra: str | None = None):
    cells, slope, shift = models.cells, models.slope, models.shift

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Models(cells, slope, shift)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                values = own.difference([t.as_py() or b"" for t in part.column(1).cast(pa.binary())])
                columns, names = [part.column(0), pa.array(values)], ["doc_id", "value"]
                if extra:
                    columns, names = [*columns, part.column(2)], [*names, extra]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def scored(docs: DataFrame, labels: DataFrame, label: str = "toxic", fold: tuple[int, int] = (4, 2), least: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row of ``docs``.

    Labels outside the held-out fold teach; ids, labels and other columns are no input of a score.
    Texts that are null or have no words show no difference and get the score of that. Documents
    labelled more than once count by their mean label, null labels not at all; without labels of both
    classes every score is the share of the class there is. Repeated rows and null ids are kept; an
    empty table gives an empty one.
    """
    models = trained(docs, labels, label, fold)
    by, out = fold
    score = 1 / (1 + F.exp(-(F.lit(models.slope) * F.col("value") + F.lit(models.shift))))
    return (
        _with_text(docs)
        .mapInArrow(frugal(_scoring(models)), "doc_id long, value double")
        .select("doc_id", (remainder("doc_id", by) == out).alias("held_out"), score.alias("score"))
        .withColumn("predicted", (F.col("score") >= least).cast("int"))
    )
