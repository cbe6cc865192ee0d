"""Connected components of a graph given as edges, as joins and aggregates on staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """Least node reachable from every node that has an edge: ``node``, ``root``.

    ``edges`` has long columns ``u``, ``v``; direction, loops and repeats don't matter, no edge
    gives no row. Alternating star contraction: every node first hands its larger, then its
    smaller neighbours to the least one it sees, which needs about log(n) rounds. Minima are
    aggregates that are reduced before the shuffle and joined back, so no node's neighbours are
    ever gathered. Each round is a table in the shared folder.
    """
    now = staged(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if tuple(state) == seen or state[0] == 0:
            break
        seen = tuple(state)
        now = staged(_small_star(_large_star(now)), "edges")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
