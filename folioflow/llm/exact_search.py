"""Exact top-k by inner product with a KD-tree per shard of the vectors.

The upper levels of one tree, with walls at medians of a sample, cut space into cells; the vectors of a cell
are one shard, or several if they are many. A shard's tree halves its vectors at medians down to small leaves
and knows the tight box of every node. A query goes to the nodes in order of the most their boxes let a vector
score, and stops when that is less than its k-th score. The first shard a query looks into is the one whose box
promises most; the k-th score found there travels with the query, so that other cells that can't beat it are
never visited and trees of those that might are cut from the start.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import Batches, frugal, staged

SCALE = 64
#: Vectors of a leaf, of a shard and queries that meet a shard in one task, at most.
LEAF, SHARD, QUERIES = 128, 16_384, 8_192
#: Cells: as many as shards are needed, within these bounds. Their boxes are sent to all tasks.
FEWEST_CELLS, MOST_CELLS = 8, 4_096
#: Components of all cells' boxes at most, which bounds what is sent for long vectors.
BOX_COMPONENTS = 1 << 20
#: Vectors a cell of the sample holds from which the walls are taken.
SAMPLED = 16
#: Queries of a task that go through a tree together.
TOGETHER = 512
#: Below every score.
NONE = -(1 << 62)

_FOUND = "query long, query_id long, vec_id long, score long"


def largest_component(dimension: int) -> int:
    """Components up to this size keep every score within 61 bits."""
    return 1 << (61 - (dimension - 1).bit_length()) // 2


def whole(column: pa.Array, dimension: int) -> np.ndarray:
    """``floor(64 * x)`` of every component, limited to :func:`largest_component`."""
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    most = float(largest_component(dimension))
    return np.clip(np.floor(values * SCALE), -most, most).astype(np.int64)


def _lists(rows: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(rows) + 1, dtype=np.int64) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.ascontiguousarray(rows).ravel()))


@dataclass(frozen=True)
class Walls:
    """The upper levels: axis and wall of every inner node, in heap order from 1."""

    axes: np.ndarray
    walls: np.ndarray

    @property
    def cells(self) -> int:
        return len(self.axes)

    def cell_of(self, rows: np.ndarray) -> np.ndarray:
        node = np.ones(len(rows), np.int64)
        for _ in range(self.cells.bit_length() - 1):
            node = 2 * node + (rows[np.arange(len(rows)), self.axes[node]] >= self.walls[node])
        return node - self.cells


def walls_of(sample: np.ndarray, cells: int) -> Walls:
    """Walls at medians of the sample, across the axis on which it spreads most."""
    axes, walls = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
    members = {1: sample}
    for node in range(1, cells):
        rows = members.pop(node)
        if len(rows):
            axes[node] = int(rows.std(0).argmax())
            walls[node] = int(np.ceil(np.median(rows[:, axes[node]])))
        right = rows[:, axes[node]] >= walls[node]
        members[2 * node], members[2 * node + 1] = rows[~right], rows[right]
    return Walls(axes, walls)


def leaves_of(rows: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Places of the rows of every leaf, from left to right: halves at the median of the widest axis until
    they are small; there are a power of two of them, none empty."""
    parts = [np.arange(len(rows))]
    for _ in range(max(0, math.ceil(math.log2(max(1, len(rows)) / leaf)))):
        halves = []
        for part in parts:
            axis = int(np.ptp(rows[part], axis=0).argmax())
            middle = len(part) // 2
            order = part[np.argpartition(rows[part, axis], middle)]
            halves += [order[:middle], order[middle:]]
        parts = halves
    return parts


class Tree:
    """A shard's tree. Nodes are in heap order from 1; ``low`` and ``high`` are their tight boxes."""

    def __init__(self, leaves: list[np.ndarray], ids: list[np.ndarray], kind: type):
        self.points = [np.ascontiguousarray(p.astype(kind)) for p in leaves]
        self.ids = ids
        n = len(leaves)
        self.low = np.zeros((2 * n, leaves[0].shape[1]), kind)
        self.high = np.zeros_like(self.low)
        for k, points in enumerate(self.points):
            self.low[n + k], self.high[n + k] = points.min(0), points.max(0)
        for node in range(n - 1, 0, -1):
            self.low[node] = np.minimum(self.low[2 * node], self.low[2 * node + 1])
            self.high[node] = np.maximum(self.high[2 * node], self.high[2 * node + 1])

    def search(self, asked: np.ndarray, own: np.ndarray, bar: np.ndarray, take: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """The best of the shard for each query: place of the query, score, id; and how many leaves were looked at.

        ``bar`` is the score from which on a vector matters, the k-th found elsewhere. All queries take
        their next step together, each to the open node whose box promises it most.
        """
        n, bar = len(self.points), bar.copy()
        plus, minus = np.maximum(asked, 0), np.minimum(asked, 0)
        promised = np.full((len(asked), 2 * n), NONE, asked.dtype)
        promised[:, 1] = plus @ self.high[1] + minus @ self.low[1]
        who, score, met = np.empty(0, np.int64), np.empty(0, asked.dtype), np.empty(0, np.int64)
        going, visits = np.arange(len(asked)), 0
        while len(going):
            open_nodes = promised[going]
            node = open_nodes.argmax(1)
            best = open_nodes[np.arange(len(going)), node]
            more = (best >= bar[going]) & (best > NONE)
            going, node = going[more], node[more]
            promised[going, node] = NONE
            inner = node < n
            rows = going[inner]
            for child in (2 * node[inner], 2 * node[inner] + 1):
                promised[rows, child] = (plus[rows] * self.high[child]).sum(1) + (minus[rows] * self.low[child]).sum(1)
            new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for leaf in np.unique(node[~inner]):
                rows = going[node == leaf]
                visits += len(rows)
                scores, ids = asked[rows] @ self.points[leaf - n].T, self.ids[leaf - n]
                r, c = np.nonzero((scores >= bar[rows, None]) & (ids != own[rows, None]))
                new.append((rows[r], scores[r, c], ids[c]))
            if sum(len(r) for r, _, _ in new):
                who, score, met = (np.concatenate([old, *parts]) for old, parts in zip((who, score, met), zip(*new)))
                order = np.lexsort((met, -score, who))
                who, score, met = who[order], score[order], met[order]
                rank = np.arange(len(who)) - np.searchsorted(who, who)
                last = rank == take - 1
                bar[who[last]] = np.maximum(bar[who[last]], score[last])
                kept = rank < take
                who, score, met = who[kept], score[kept], met[kept]
        return who, score, met, visits


def finite(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``x`` of vectors with components, none null or non-finite, once each."""
    x = F.col("embedding")
    good = F.forall(x, lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False)))
    rows = vectors.where(x.isNotNull() & (F.size(x) > 0) & good & F.col("vec_id").isNotNull())
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).distinct()


def cells_for(points: int, dimension: int) -> int:
    """A power of two: one cell per shard, at least a few if each still fills some leaves."""
    most = min(MOST_CELLS, max(1, BOX_COMPONENTS // dimension))
    wanted = max(points / SHARD, min(FEWEST_CELLS, points / LEAF))
    return 1 << max(0, min(math.floor(math.log2(most)), math.ceil(math.log2(max(1, wanted)))))


def _in_cells(points: DataFrame, walls: Walls, dimension: int) -> DataFrame:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                rows = whole(batch.column(1), dimension)
                yield pa.RecordBatch.from_arrays([pa.array(walls.cell_of(rows)), batch.column(0), _lists(rows)], ["cell", "vec_id", "x"])

    return points.select("vec_id", "x").mapInArrow(frugal(run), "cell long, vec_id long, x array<long>")


def _trees(points: DataFrame, dimension: int) -> DataFrame:
    """One row per leaf: ``cell, piece, leaf, ids, x``; the components of a leaf's vectors follow each other."""

    def run(shard: pa.Table) -> pa.Table:
        rows = pc.list_flatten(shard.column("x")).to_numpy().reshape(-1, dimension)
        ids = shard.column("vec_id").to_numpy()
        parts = leaves_of(rows, LEAF)
        return pa.table(
            {
                "cell": pa.array(np.full(len(parts), shard.column("cell")[0].as_py())),
                "piece": pa.array(np.full(len(parts), shard.column("piece")[0].as_py())),
                "leaf": pa.array(np.arange(len(parts))),
                "ids": pa.array([ids[p] for p in parts], pa.list_(pa.int64())),
                "x": pa.array([rows[p].ravel() for p in parts], pa.list_(pa.int64())),
            }
        )

    return points.groupBy("cell", "piece").applyInArrow(run, "cell long, piece long, leaf long, ids array<long>, x array<long>")


def _boxes(points: DataFrame) -> list:
    """Tight boxes of the cells: at most ``MOST_CELLS`` rows, reduced before the shuffle."""
    sides = points.select("cell", F.posexplode("x").alias("axis", "v")).groupBy("cell", "axis")
    sides = sides.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return sides.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("axis", "low", "high"))).alias("box")).collect()


@dataclass(frozen=True)
class Cells:
    """Numbers and boxes of the cells that hold vectors."""

    numbers: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def promised(self, rows: np.ndarray) -> np.ndarray:
        """The most a vector of each cell can score, rounded up a little where doubles are not exact."""
        exact = rows.astype(np.float64)
        most = np.maximum(exact, 0) @ self.high.T + np.minimum(exact, 0) @ self.low.T
        return most + 1e-12 * (np.abs(exact) @ np.maximum(np.abs(self.low), np.abs(self.high)).T)


def _sent(queries: DataFrame, cells: Cells, dimension: int, first: bool) -> DataFrame:
    """Queries with the cells they visit: the most promising one, or all others that may reach their bar."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pc.list_flatten(batch.column(2)).to_numpy().reshape(-1, dimension)
            promised = cells.promised(rows)
            home = promised.argmax(1)
            if first:
                visits = np.zeros(promised.shape, bool)
                visits[np.arange(len(rows)), home] = True
            else:
                visits = promised >= batch.column(3).to_numpy()[:, None]
                visits[np.arange(len(rows)), home] = False
            row, cell = np.nonzero(visits)
            picked = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(cells.numbers[cell]), *picked.columns], ["cell", "query", "query_id", "x", "bar"])

    return queries.select("query", "query_id", "x", "bar").mapInArrow(
        frugal(run), "cell long, query long, query_id long, x array<long>, bar long"
    )


def _searched(trees: DataFrame, pieces: DataFrame, sent: DataFrame, dimension: int, take: int) -> DataFrame:
    """Meet every shard of a cell with the queries sent there, in shares of at most about ``QUERIES``."""
    shares = sent.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(QUERIES)).alias("shares"))
    # A row per cell, of which there are at most MOST_CELLS.
    dealt = sent.join(F.broadcast(pieces), "cell").join(F.broadcast(shares), "cell")
    dealt = dealt.withColumn("share", F.pmod(F.xxhash64("query", "query_id"), F.col("shares")))
    dealt = dealt.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    shards = trees.join(F.broadcast(shares), "cell")
    shards = shards.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))

    def run(leaves: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(4)]
        if leaves.num_rows and asked.num_rows:
            leaves = leaves.sort_by("leaf")
            points = [np.asarray(v.values).reshape(-1, dimension) for v in leaves.column("x")]
            ids = [np.asarray(v.values) for v in leaves.column("ids")]
            rows = pc.list_flatten(asked.column("x")).to_numpy().reshape(-1, dimension)
            most = int(np.abs(rows).max()) * max(int(np.abs(p).max()) for p in points) * dimension
            kind = np.float64 if most < 2**53 else np.int64
            tree = Tree(points, ids, kind)
            query, own, bar = (asked.column(c).to_numpy() for c in ("query", "query_id", "bar"))
            for at in range(0, len(rows), TOGETHER):
                some = slice(at, at + TOGETHER)
                who, score, met, _ = tree.search(rows[some].astype(kind), own[some], bar[some].astype(kind), take)
                for k, values in enumerate((query[some][who], own[some][who], met, score.astype(np.int64))):
                    out[k].append(values)
        return pa.table([np.concatenate(c) for c in out], names=["query", "query_id", "vec_id", "score"])

    key = ("cell", "piece", "share")
    return shards.select(*key, "leaf", "ids", "x").groupBy(*key).cogroup(
        dealt.select(*key, "query", "query_id", "x", "bar").groupBy(*key)
    ).applyInArrow(run, _FOUND)


def top(vectors: DataFrame, queries_every: int = 20, k: int = 20) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` highest scores of every query, exactly.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are ignored. Components become ``floor(64 * x)``,
    the score is their inner product in whole numbers, ties go to the smaller id. Queries are the vectors
    whose id is divisible by ``queries_every``, candidates those with another id. Null vectors and ids and
    vectors with null or non-finite components take no part, nor do those of another dimension than most.
    Rows repeated with id and vector count once, an id on several vectors is answered for each. Components
    beyond :func:`largest_component` (in 64 dimensions 2^27, for x of two million) count as that. Of equal vectors
    only the ``k + 1`` smallest ids can be among the best of any query, so no more are put into trees. An
    empty table gives an empty result, fewer candidates than ``k`` give fewer ranks.
    """
    rows = staged(finite(vectors), "vectors")
    size = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if size is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dimension = size["d"]
    rows = rows.where(F.size("x") == dimension)
    copies = Window.partitionBy("x").orderBy("vec_id")
    unlike = rows.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k + 1).drop("_copy")
    unlike = staged(unlike, "candidates")
    cells = cells_for(unlike.count(), dimension)
    sample = unlike.orderBy(F.xxhash64("vec_id", "x")).limit(SAMPLED * cells).select("x").toArrow()
    walls = walls_of(whole(sample.column("x").combine_chunks(), dimension), cells)
    placed = staged(_in_cells(unlike, walls, dimension), "placed")
    pieces = staged(placed.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(SHARD)).alias("pieces")), "pieces")
    shard = F.pmod(F.xxhash64("vec_id", "x"), F.col("pieces"))
    trees = staged(_trees(placed.join(F.broadcast(pieces), "cell").withColumn("piece", shard), dimension), "trees")
    known = sorted(_boxes(placed), key=lambda r: r["cell"])
    boxes = Cells(
        np.array([r["cell"] for r in known]),
        np.array([[s["low"] for s in r["box"]] for r in known], np.float64),
        np.array([[s["high"] for s in r["box"]] for r in known], np.float64),
    )
    asked = _in_cells(rows.where(F.col("vec_id") % queries_every == 0), walls, dimension)
    asked = asked.select(F.xxhash64("vec_id", "x").alias("query"), F.col("vec_id").alias("query_id"), "x")
    asked = staged(asked.distinct(), "queries")
    start = asked.withColumn("bar", F.lit(NONE))
    first = staged(_searched(trees, pieces, _sent(start, boxes, dimension, True), dimension, k), "first")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    bars = ranked.where(F.col("rank") == k).select("query_id", "query", F.col("score").alias("bar"))
    others = asked.join(bars, ["query_id", "query"], "left").withColumn("bar", F.coalesce("bar", F.lit(NONE)))
    sent = staged(_sent(others, boxes, dimension, False), "sent")
    found = first.unionByName(_searched(trees, pieces, sent, dimension, k))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
