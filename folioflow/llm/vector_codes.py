"""Vectors as short codes: each of 16 parts is stood for by the nearest of 64 entries, in whole numbers only.

Parts and entries are padded with zeros to a power of two and put through the Walsh-Hadamard transform, which
adds and subtracts and makes every squared distance ``size`` times as large. The squared differences of the
transforms are added up in order of sequency, a few at a time. Smooth differences show in the first of them, so
most entries are seen to be too far before the sum is complete, and are left out from there on. What is left
out has a sum above that of an entry already known in full, so nothing is approximated.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import Batches, frugal, staged
from folioflow.operators.skew import broadcast_if_small

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Shares a label's rows are dealt into where the labels are too many to be sent to every task.
SHARES = 32
#: The first step adds up so many squares; each later step twice as many as the one before.
FIRST_SQUARES = 2


def transform(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform along the last axis, padded with zeros to a power of two, by sequency."""
    width = rows.shape[-1]
    size = 1 << max(0, width - 1).bit_length()
    out = np.zeros((*rows.shape[:-1], size), np.int64)
    out[..., :width] = rows
    step = 1
    while step < size:
        pairs = out.reshape(*rows.shape[:-1], size // (2 * step), 2, step)
        out = np.stack((pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]), axis=-2)
        out = out.reshape(*rows.shape[:-1], size)
        step *= 2
    return out[..., sequency_order(size)]


def sequency_order(size: int) -> np.ndarray:
    """Rows of the transform by how often their signs change: the Gray code of the place, its bits reversed."""
    bits = size.bit_length() - 1
    gray = np.arange(size) ^ (np.arange(size) >> 1)
    out = np.zeros(size, np.int64)
    for _ in range(bits):
        out, gray = out << 1 | gray & 1, gray >> 1
    return out


def largest_component(width: int) -> int:
    """Components up to this size keep all sums of a part's transform within 63 bits."""
    size = 1 << max(0, width - 1).bit_length()
    return 1 << (60 - (size * max(1, width) - 1).bit_length()) // 2


@dataclass(frozen=True)
class Codebooks:
    """``entries``: (part, entry, component) whole numbers."""

    entries: np.ndarray

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of every part, ties to the lower, and the squared distances."""
        parts = vectors.reshape(len(vectors), PARTS, -1)
        codes, errors = np.empty(parts.shape[:2], np.int64), np.empty(parts.shape[:2], np.int64)
        for j in range(PARTS):
            codes[:, j], errors[:, j] = _nearest(transform(parts[:, j]), transform(self.entries[j]))
        return codes, errors

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = parts.shape[1]
    at = min(FIRST_SQUARES, size)
    sums = ((parts[:, None, :at] - entries[None, :, :at]) ** 2).sum(-1)
    # The best so far is known in full: no entry above it can win.
    guess = sums.argmin(1)
    bound = ((parts - entries[guess]) ** 2).sum(1)
    row, entry = np.nonzero(sums <= bound[:, None])
    so_far = sums[row, entry]
    step = at
    while at < size:
        more = slice(at, at + step)
        so_far = so_far + ((parts[row, more] - entries[entry, more]) ** 2).sum(1)
        at, step = at + step, step * 2
        near = so_far <= bound[row]
        row, entry, so_far = row[near], entry[near], so_far[near]
    # Rows and entries come in order: the first of the least sums is the lowest index.
    starts = np.searchsorted(row, np.arange(len(parts)))
    least = np.minimum.reduceat(so_far, starts) if len(parts) else so_far
    hit = so_far == least[row]
    row, entry = row[hit], entry[hit]
    return entry[np.searchsorted(row, np.arange(len(parts)))], least // size


def _whole(column: pa.Array, dimension: int) -> np.ndarray:
    """Components as whole numbers, padded with zeros to equal parts."""
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    width = -(-dimension // PARTS)
    most = float(largest_component(width))
    out = np.zeros((len(values), PARTS * width), np.int64)
    out[:, :dimension] = np.clip(np.floor(values * SCALE), -most, most)
    return out


def finite(vectors: DataFrame) -> DataFrame:
    """Rows whose vector has components, none of them null or non-finite: ``vec_id``, ``label``, ``x``."""
    x = F.col("embedding")
    good = F.forall(x, lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False)))
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")
    return vectors.where(x.isNotNull() & (F.size(x) > 0) & good).select(F.col("vec_id").cast("long").alias("vec_id"), label, x.alias("x"))


def common_dimension(rows: DataFrame) -> int:
    """The dimension most vectors have, the smaller of equals; 0 if there are none."""
    top = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return top["d"] if top else 0


def _first_entries(rows: DataFrame, dimension: int) -> Codebooks:
    """Parts of the vectors with the smallest ids; each task keeps no more than these."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).select("x").toArrow()
    whole = _whole(first.column("x").combine_chunks(), dimension)
    return Codebooks(np.ascontiguousarray(whole.reshape(len(whole), PARTS, whole.shape[1] // PARTS).swapaxes(0, 1)))


def _moved(rows: DataFrame, books: Codebooks, dimension: int) -> Codebooks:
    """Entries in the middle of the parts nearest to them. Every task hands on one sum per entry and
    component, so what is shuffled and collected does not depend on the number of vectors."""
    _, entries, width = books.entries.shape

    def run(batches: Batches) -> Batches:
        sums, counts = np.zeros(books.entries.shape, np.int64), np.zeros((PARTS, entries), np.int64)
        met = False
        for batch in batches:
            whole = _whole(batch.column(0), dimension)
            codes, _ = books.nearest(whole)
            for j in range(PARTS):
                np.add.at(sums[j], codes[:, j], whole.reshape(len(whole), PARTS, -1)[:, j])
                counts[j] += np.bincount(codes[:, j], minlength=entries)
            met = met or batch.num_rows > 0
        if met:
            part, entry = np.nonzero(counts)
            for at in range(0, len(part), 256):
                p, e = part[at : at + 256], entry[at : at + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p), pa.array(e), pa.array(counts[p, e]), pa.array(sums[p, e].tolist(), pa.list_(pa.int64()))],
                    ["part", "entry", "n", "sums"],
                )

    partial = rows.select("x").mapInArrow(frugal(run), "part long, entry long, n long, sums array<long>")
    added = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"c{k}") for k in range(width)]
    out = books.entries.copy()
    for r in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added).collect():
        out[r["part"], r["entry"]] = [_floored(r[f"c{k}"], r["n"]) for k in range(width)]
    return Codebooks(out)


def _floored(total: Decimal, count: int) -> int:
    return int(total) // int(count)


def _coded(rows: DataFrame, books: Codebooks, dimension: int) -> DataFrame:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                codes, errors = books.nearest(_whole(batch.column(2), dimension))
                spelt = [bytes(c).hex() for c in codes.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(spelt), pa.array(errors.sum(1))], ["vec_id", "label", "code", "error"]
                )

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(frugal(run), f"vec_id long, label {label}, code string, error long")


def _with_label_error(coded: DataFrame) -> DataFrame:
    """Add the errors of all rows with the same label. Sums are reduced before the shuffle; few labels are
    sent to the rows, of many each is repeated for the shares its rows are dealt into."""
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.least(total, most).cast("long").alias("label_error"))

    def same(share: Column) -> Column:
        return F.col("label").eqNullSafe(F.col("_label")) & share

    small = broadcast_if_small(totals)
    if small is not totals:
        return coded.join(small, same(F.lit(True))).drop("_label")
    dealt = coded.withColumn("_share", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SHARES)))
    repeated = totals.withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    return dealt.join(repeated, same(F.col("_share") == F.col("_of"))).drop("_label", "_share", "_of")


def coded(vectors: DataFrame) -> tuple[DataFrame, Codebooks | None]:
    """Rows ``vec_id``, ``code``, ``error``, ``label_error``, and the codebooks they refer to.

    ``vectors`` has ``vec_id``, ``embedding`` and maybe ``label``; other columns are ignored. Null vectors and
    those with null or non-finite components take no part; nor do those of another dimension than most. A
    dimension that 16 does not divide is padded with zeros at its end. Components become
    ``floor(256 * x)``; beyond :func:`largest_component` (a million, for 64 dimensions) they count as that, so
    that no sum leaves 63 bits. Every row counts, also repeated ones and those with null ids, which come
    last when the first entries are picked, like rows with equal ids by their vectors. With fewer than 64 rows
    there are as many entries as rows; an empty table gives no rows and no codebooks.
    """
    rows = finite(vectors)
    dimension = common_dimension(rows)
    if dimension == 0:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long"), None
    rows = rows.where(F.size("x") == dimension)
    books = _first_entries(rows, dimension)
    for _ in range(ROUNDS):
        books = _moved(rows, books, dimension)
    codes = staged(_coded(rows, books, dimension), "codes")
    return _with_label_error(codes).select("vec_id", "code", "error", "label_error"), books


def digest(vectors: DataFrame) -> DataFrame:
    """The codes with a digest of the codebooks on every row."""
    rows, books = coded(vectors)
    return rows.withColumn("codebooks_sha256", F.lit(books.digest() if books else None).cast("string"))
