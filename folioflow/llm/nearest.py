"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table has M hash functions floor((a . x + b) / w) with normal a: near vectors tend to share buckets.
A query looks into its own bucket and then into perturbed ones, those first that by the distances to
the cell walls are likeliest to hold a neighbour. What the tables turn up is ranked by exact distance.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import staged

#: Vectors the index is fitted on: those with the least hash. All vectors are indexed.
SAMPLE = 6000
#: Queries of the sample that measure how many probes are needed.
MEASURED = 64
TABLES = 8
#: Vectors a bucket should hold on average.
OCCUPANCY = 100
#: Share of the sample's neighbours that the probes must find.
RECALL = 0.95
#: Buckets a query visits in a table at most; if they don't give the recall, the cells are made coarser.
MOST_PROBES = 4096
#: Vectors or queries of one bucket that one task compares at a time.
BLOCK = 20_000


@dataclass(frozen=True)
class Hashes:
    """The tables' hash functions: ``lines`` (dimension, tables * functions), ``shifts``, ``width``, and
    how many buckets a query visits in each table."""

    lines: np.ndarray
    shifts: np.ndarray
    width: float
    tables: int
    probes: int

    def cells(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell numbers (rows, tables, functions), and the place in the cell from 0 to 1."""
        at = (rows @ self.lines + self.shifts) / self.width
        cell = np.floor(at)
        shape = (len(rows), self.tables, -1)
        return cell.astype(np.int64).reshape(shape), (at - cell).reshape(shape)


def bucket_ids(cells: np.ndarray) -> np.ndarray:
    """One number for the cells of all functions of a table (last axis)."""
    out = np.zeros(cells.shape[:-1], np.uint64)
    for k in range(cells.shape[-1]):
        out = (out ^ (cells[..., k].astype(np.uint64) + np.uint64(0x9E37))) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def perturbations(place: np.ndarray, most: int) -> list[list[tuple[int, int]]]:
    """Sets of (function, step) in the order of their score, the sum of squared distances to the walls
    that they cross; the first is the empty set. ``place`` holds the places in the cells."""
    walls = sorted(
        [(float(x) ** 2, k, -1) for k, x in enumerate(place)] + [(float(1 - x) ** 2, k, 1) for k, x in enumerate(place)]
    )
    out: list[list[tuple[int, int]]] = [[]]
    heap = [(walls[0][0], (0,))]
    while heap and len(out) < most:
        score, chosen = heapq.heappop(heap)
        if len({walls[i][1] for i in chosen}) == len(chosen):
            out.append([walls[i][1:] for i in chosen])
        last = chosen[-1]
        if last + 1 < len(walls):
            heapq.heappush(heap, (score + walls[last + 1][0], (*chosen, last + 1)))
            heapq.heappush(heap, (score - walls[last][0] + walls[last + 1][0], (*chosen[:-1], last + 1)))
    return out


def probed(hashes: Hashes, rows: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int, np.ndarray]]:
    """For each row and table the buckets to visit, in order."""
    cells, places = hashes.cells(rows)
    for row in range(len(rows)):
        for t in range(hashes.tables):
            steps = perturbations(places[row, t], most or hashes.probes)
            own = np.repeat(cells[row, t][None], len(steps), axis=0)
            for k, moves in enumerate(steps):
                for function, step in moves:
                    own[k, function] += step
            yield row, t, bucket_ids(own)


def fitted(sample: np.ndarray, total: int, seed: int = 3) -> Hashes:
    """Functions for ``total`` vectors like the sample, which also tells how many probes are needed.

    More functions cut finer, so that buckets keep their size while vectors grow in number. The cells
    are so wide that a function mostly knows two of them. Where ``MOST_PROBES`` buckets a table don't
    reach the recall, there are fewer functions, and a last one gets wider cells: buckets are larger
    then, but none of the recall is given up. The sample's own nearest neighbours are farther apart than
    those among all vectors, so measuring on it asks for too many probes rather than too few.
    """
    functions = max(1, min(20, round(math.log2(max(2, total / OCCUPANCY)))))
    queries = sample[: min(MEASURED, len(sample))]
    distances = np.sqrt(np.maximum((queries**2).sum(1)[:, None] + (sample**2).sum(1) - 2 * queries @ sample.T, 0))
    distances[np.arange(len(queries)), np.arange(len(queries))] = np.inf
    k = min(10, len(sample) - 1)
    if k < 1:
        return _drawn(sample, functions, 3.0, seed, 2**functions)
    near = np.argpartition(distances, k - 1, axis=1)[:, :k]

    def measured(functions: int, deviations: float = 3.0) -> Hashes | None:
        hashes = _drawn(sample, functions, deviations, seed, 1)
        limit = min(3**functions, MOST_PROBES)
        needed = _needed(hashes, sample, queries, near, limit)
        return replace(hashes, probes=needed) if needed <= limit else None

    best = measured(functions)
    # The most functions that reach it, halving what is between those that do and those that don't.
    enough, above = (0, functions) if best is None else (functions, functions + 1)
    while above - enough > 1:
        middle = (enough + above) // 2
        fit = measured(middle)
        if fit is None:
            above = middle
        else:
            best, enough = fit, middle
    deviations = 3.0
    while best is None:
        deviations *= 2
        best = measured(1, deviations)
    return best


def _drawn(sample: np.ndarray, functions: int, deviations: float, seed: int, probes: int) -> Hashes:
    """Functions whose cells are so many deviations of the sample wide."""
    draw = np.random.default_rng(seed)
    lines = draw.standard_normal((sample.shape[1], TABLES * functions))
    along = sample @ lines
    width = float(max(deviations * np.median(np.std(along, axis=0)), 1e-9))
    # One wall of each function goes through the middle of the sample.
    shifts = -np.median(along, axis=0) + np.where(draw.random(TABLES * functions) < 0.5, 0.0, 0.5) * width * 0.1
    return Hashes(lines, shifts, width, TABLES, probes)


def _needed(hashes: Hashes, sample: np.ndarray, queries: np.ndarray, near: np.ndarray, limit: int) -> int:
    """Probes a table that meet ``RECALL`` of the neighbours ``near``; more than ``limit`` if those don't."""
    ids = bucket_ids(hashes.cells(sample)[0])
    # At which probe does a table first turn up each neighbour? Twice as many probes until enough are met.
    most = 16
    while True:
        first = np.full(near.shape, limit + 1, np.int64)
        for row, t, visited in probed(hashes, queries, most):
            order = {int(b): p for p, b in reversed(list(enumerate(visited)))}
            for j, other in enumerate(near[row]):
                first[row, j] = min(first[row, j], order.get(int(ids[other, t]), limit + 1))
        needed = int(np.sort(first.ravel())[math.ceil(RECALL * first.size) - 1]) + 1
        if needed <= limit or most >= limit:
            return needed
        most *= 2


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def usable(vectors: DataFrame, dimension: int) -> DataFrame:
    """``vec_id``, ``x`` of vectors that take part: no nulls, all finite, not zero, of this dimension."""
    x = F.col("embedding")
    good = (
        F.col("embedding").isNotNull()
        & (F.size(x) == dimension)
        & F.forall(x, lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False)))
        & F.exists(x, lambda v: v != 0)
    )
    return vectors.where(good & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def _split(rows: DataFrame, mine: str, other: str, own_heavy: DataFrame, other_heavy: DataFrame) -> DataFrame:
    """Give rows of full buckets one of several shares, and repeat rows for every share of the other side."""
    with_own = rows.join(own_heavy.withColumnRenamed("shares", "_own"), ["t", "bucket"], "left")
    both = with_own.join(other_heavy.withColumnRenamed("shares", "_other"), ["t", "bucket"], "left")
    return (
        both.withColumn(mine, F.pmod(F.xxhash64("id"), F.coalesce("_own", F.lit(1))).cast("int"))
        .withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_other").cast("int"), F.lit(1)) - 1)))
        .drop("_own", "_other")
    )


def _heavy(rows: DataFrame, block: int) -> DataFrame:
    return staged(
        rows.groupBy("t", "bucket").agg(F.count("*").alias("n")).where(F.col("n") > block)
        .select("t", "bucket", F.ceil(F.col("n") / block).alias("shares")),
        "heavy",
    )


def _indexed(nodes: DataFrame, hashes: Hashes, dimension: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = bucket_ids(hashes.cells(_matrix(batch.column(1), dimension))[0])
            for t in range(hashes.tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, t, np.int32)), pa.array(ids[:, t].copy()), batch.column(0), batch.column(1)],
                    ["t", "bucket", "id", "x"],
                )

    return nodes.select("id", "x").mapInArrow(run, f"t int, bucket long, id long, x {nodes.schema['x'].dataType.simpleString()}")


def _squares(asked: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return (asked**2).sum(1)[:, None] + (rows**2).sum(1) - 2 * asked @ rows.T


def _nearest_of(asked: np.ndarray, rows: np.ndarray, take: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact distances of the nearest rows of each query; a few more are measured exactly
    than are taken, because the quick squares are rounded."""
    more = min(len(rows), take + 4)
    near = np.argpartition(_squares(asked, rows), more - 1, axis=1)[:, :more]
    exact = np.sqrt(((rows[near] - asked[:, None]) ** 2).sum(-1))
    order = np.argsort(exact, axis=1, kind="stable")[:, : min(take, len(rows))]
    return np.take_along_axis(near, order, 1), np.take_along_axis(exact, order, 1)


def _anchored(queries: DataFrame, ids: np.ndarray, sample: np.ndarray, take: int) -> DataFrame:
    """Add ``near``, the nearest of the sample, and ``reach``, the distance of the last of them: what
    lies farther can't be among a query's nearest."""
    dimension = sample.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("id", pa.int64()), ("score", pa.float64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                near, exact = _nearest_of(_matrix(part.column(1), dimension), sample, take)
                rows = [[{"id": int(i), "score": float(d)} for i, d in zip(ids[n], e)] for n, e in zip(near, exact)]
                reach = exact[:, -1] if exact.shape[1] >= take else np.full(len(exact), np.inf)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(reach), pa.array(rows, kind)], ["id", "x", "reach", "near"]
                )

    x = queries.schema["x"].dataType.simpleString()
    return queries.select("id", "x").mapInArrow(run, f"id long, x {x}, reach double, near array<struct<id:bigint,score:double>>")


def _probes(queries: DataFrame, hashes: Hashes, dimension: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = list(probed(hashes, _matrix(part.column(1), dimension)))
                rows = pa.array(np.concatenate([np.full(len(b), r) for r, _, b in found]))
                tables = np.concatenate([np.full(len(b), t, np.int32) for _, t, b in found])
                buckets = np.concatenate([b for _, _, b in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tables), pa.array(buckets), *[part.column(k).take(rows) for k in range(3)]],
                    ["t", "bucket", "id", "x", "reach"],
                )

    x = queries.schema["x"].dataType.simpleString()
    return queries.select("id", "x", "reach").mapInArrow(run, f"t int, bucket long, id long, x {x}, reach double")


def _compared(index: DataFrame, probes: DataFrame, take: int, dimension: int) -> DataFrame:
    """The nearest of every bucket for every query that visits it, within its reach: ``query``, ``id``, ``score``."""
    heavy, busy = _heavy(index, BLOCK), _heavy(probes, BLOCK)
    left = _split(index, "a", "b", heavy, busy)
    right = _split(probes, "b", "a", busy, heavy)

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]]
        if mine.num_rows and theirs.num_rows:
            rows, ids = _matrix(mine.column("x").combine_chunks(), dimension), mine.column("id").to_numpy()
            for at in range(0, theirs.num_rows, 256):
                some = theirs.slice(at, 256)
                near, exact = _nearest_of(_matrix(some.column("x").combine_chunks(), dimension), rows, take)
                inside = exact <= some.column("reach").to_numpy()[:, None] * (1 + 1e-12)
                asked = np.repeat(some.column("id").to_numpy()[:, None], near.shape[1], axis=1)
                for k, values in enumerate((asked, ids[near], exact)):
                    out[k].append(values[inside])
        return pa.table([np.concatenate(x) for x in out], names=["query", "id", "score"])

    return left.groupBy("t", "bucket", "a", "b").cogroup(right.groupBy("t", "bucket", "a", "b")).applyInArrow(
        run, "query long, id long, score double"
    )


def neighbours(vectors: DataFrame, queries_every: int = 100, k: int = 10) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` nearest found of every query.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are ignored. Queries are rows whose id is
    divisible by ``queries_every``; the query's own id is no candidate. Euclidean distance in double
    precision, ties to the smaller id. Vectors that are null, zero, of another dimension than most, or that
    hold null or non-finite numbers take no part; nor do null ids. Equal vectors are indexed once and
    stand for their least ids, so a vector with a million copies is one row of a bucket; rows repeated
    with id and vector count once, an id on several vectors is answered for each. The nearest of the
    sample are candidates of every query, so ``k`` are found if there are so many. Empty tables, and
    tables without candidates, give an empty result.
    """
    sizes = vectors.where("embedding is not null").groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    top = sizes.where("d > 0").orderBy(F.desc("n"), "d").first()
    dimension = top["d"] if top else 1
    rows = staged(usable(vectors, dimension).distinct(), "vectors")
    least = Window.partitionBy("x").orderBy("vec_id")
    nodes = staged(
        rows.withColumn("place", F.row_number().over(least))
        .where(F.col("place") <= k + 1)
        .groupBy("x")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("id", F.xxhash64("x", "ids")),
        "nodes",
    )
    total = nodes.count()
    if total == 0:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    drawn = nodes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("id", "x").toArrow()
    sample = _matrix(drawn.column("x").combine_chunks(), dimension)
    hashes = fitted(sample, total)
    asked = rows.where(F.col("vec_id") % queries_every == 0).withColumn("id", F.xxhash64("x", "vec_id"))
    asked = staged(asked, "queries")
    anchored = staged(_anchored(asked, drawn.column("id").to_numpy(), sample, k + 1), "anchored")
    found = _compared(staged(_indexed(nodes, hashes, dimension), "index"), _probes(anchored, hashes, dimension), k + 1, dimension)
    anchors = anchored.select(F.col("id").alias("query"), F.explode("near").alias("a")).select("query", "a.id", "a.score")
    # What the tables and the sample turn up, each once; then nodes stand for the ids of their copies.
    met = found.unionByName(anchors).groupBy("query", "id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query").orderBy("score", F.col("ids")[0])
    kept = met.join(nodes.select("id", "ids"), "id").withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    named = asked.select(F.col("id").alias("query"), F.col("vec_id").alias("query_id"))
    each = kept.select("query", "score", F.explode("ids").alias("vec_id")).join(named, "query").where("vec_id <> query_id")
    each = each.groupBy("query", "query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
