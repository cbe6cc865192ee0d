"""Building blocks that keep one hot key from landing in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.session import cut_lineage


def spread_nulls(key: Column, row_id: Column) -> Column:
    """Join key in which every null becomes its own value, so nulls neither match nor pile up."""
    return F.coalesce(key, F.concat(F.lit("\x00"), row_id))


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast only after counting that there are few rows; else leave the join to shuffle."""
    rows = df.limit(max_rows + 1).count()
    return F.broadcast(df) if rows <= max_rows else df


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One whole row per key: the first by ``order``.

    An aggregate, not a window: copies of a hot key are reduced before the shuffle.
    """
    first = F.min_by(F.struct("*"), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(first).select("_row.*")


def mark_winner(
    df: DataFrame, keys: list[str], order: list[Column], row_id: str, out: str, last: bool = False
) -> DataFrame:
    """Add boolean ``out``: the row is the first (or last) of its key by ``order``.

    The winners (one id per key, reduced map-side) are joined back on the unique row id, so a key
    that holds a third of all rows is never brought together.
    """
    pick = F.max_by if last else F.min_by
    winners = df.groupBy(*keys).agg(pick(row_id, F.struct(*order)).alias(row_id)).select(row_id)
    return df.join(winners.withColumn(out, F.lit(True)), row_id, "left").withColumn(
        out, F.coalesce(out, F.lit(False))
    )


def in_blocks(df: DataFrame, order: list[str], blocks: int | None = None) -> DataFrame:
    """Add ``block``: range-partition number of the row in the total order given by ``order``.

    With a unique column last in ``order`` the blocks stay even under any key skew. The rows are
    written once because range bounds are sampled: a second evaluation could cut elsewhere.
    """
    parts = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(parts, *order).withColumn("block", F.spark_partition_id())
    return cut_lineage(cut)


def run_length(df: DataFrame, key: str, order: list[str], reset: Column, out: str) -> DataFrame:
    """Number the rows of each key since the last row where ``reset`` holds, which counts as 0.

    ``df`` comes from :func:`in_blocks`. Windows run inside (block, key); what earlier blocks
    carry in comes from one summary row per block and key.
    """
    within = Window.partitionBy("block", key).orderBy(*order)
    flagged = df.withColumn("_reset", F.coalesce(reset, F.lit(False)).cast("int"))
    local = flagged.withColumn("_resets", F.sum("_reset").over(within)).withColumn(
        "_local",
        F.sum(1 - F.col("_reset")).over(Window.partitionBy("block", key, "_resets").orderBy(*order)),
    )
    # Rows after the last reset of a block, for every block of a key; at most one row per block and key.
    tails = flagged.groupBy("block", key).agg(F.max(F.when(F.col("_reset") == 1, F.struct(*order))).alias("_last"))
    tail_rows = flagged.join(tails, ["block", key]).where(
        F.col("_last").isNull() | (F.struct(*order) > F.col("_last"))
    )
    summary = tails.join(tail_rows.groupBy("block", key).agg(F.count("*").alias("_tail")), ["block", key], "left")
    by_key = Window.partitionBy(key).orderBy("block")
    carried = (
        summary.withColumn("_era", F.count("_last").over(by_key))
        .withColumn(
            "_out", F.sum(F.coalesce("_tail", F.lit(0))).over(Window.partitionBy(key, "_era").orderBy("block"))
        )
        .withColumn("_carry", F.lag("_out", 1, 0).over(by_key))
        .select("block", key, "_carry")
    )
    return (
        local.join(carried, ["block", key])
        .withColumn(out, F.col("_local") + F.when(F.col("_resets") == 0, F.col("_carry")).otherwise(0))
        .drop("_reset", "_resets", "_local", "_carry")
    )


def running_total(df: DataFrame, key: str, order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same key that come before.

    ``df`` comes from :func:`in_blocks` with ``key`` first in its order. Sums run inside (block, key); what
    earlier blocks add comes from one row per block and key.
    """
    before = Window.partitionBy("block", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_before", F.coalesce(F.sum(value).over(before), F.lit(0)))
    earlier = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy("block", key).agg(F.sum(value).alias("_sum"))
    carried = totals.withColumn("_carry", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    return local.join(carried, ["block", key]).withColumn(out, F.col("_before") + F.col("_carry")).drop("_before", "_carry")
