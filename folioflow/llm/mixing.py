"""Mixing sources to target weights by Pareto order sampling. Columns only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import random_unit, staged, whole_row, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
#: The ranks of a source are counted in so many cells; the cell that matters is cut again, up to so often,
#: while it holds more ranks than one task is to sort. Ranks have 48 random bits, those of four levels.
CELLS, LEVELS = 4096, 4
SORTED = 100_000
#: So many ranks of a source that still fit are walked down in one row.
WALKED = 20_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``source``, ``source_size``, ``target`` from rows of ``source`` and ``size``.

    Sources by code point, null last, get the weights in turn. ``share`` times all sizes is dealt out
    by weight; a target stops at ``MOST_COPIES`` times its source's size and what is above goes to the
    others by weight. That is the level ``l`` at which the sum of ``least(limit, l * weight)`` is the
    whole: sources in the order of limit / weight fill up first; the level is that before the first
    source that doesn't, after which the levels only fall. One row for each source passes through
    one window, no documents.
    """
    each = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(place, F.lit(len(weights))))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limited = each.withColumn("weight", weight).withColumn("limit", MOST_COPIES * F.col("source_size"))
    limited = limited.withColumn("ratio", F.col("limit").cast("double") / F.col("weight"))
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    levelled = limited.withColumn(
        "level",
        (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))),
    ).withColumn("level", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(everything))
    full = F.col("level").isNull() | (F.col("ratio") <= F.col("level"))
    target = F.when(full, F.col("limit").cast("double")).otherwise(F.col("level") * F.col("weight"))
    return levelled.select("source", "source_size", target.alias("target"))


def _placed(docs: DataFrame, seed: int) -> DataFrame:
    """Add what a row's rank rests on: ``_s`` (its source, null told from empty), ``_t``, ``_u``."""
    return (
        docs.withColumn("_s", _source_key(F.col("source").cast("string")))
        .withColumn("_t", F.md5(F.coalesce(F.col("text"), F.lit(""))))
        .withColumn("_u", random_unit(seed, "doc_id", "_t"))
    )


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def _ranked(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Add the place in Pareto order, ``_o``: random odds over inclusion odds brought to (0, 1), then id and text."""
    odds = (F.col("_u") / (1 - F.col("_u"))) / (F.col("part") / (1 - F.col("part")))
    rank = F.when(F.col("part") > 0, odds / (1 + odds))
    return rows.join(rates, "_s").withColumn("_o", F.struct(rank.alias("z"), F.coalesce("doc_id", F.lit(-1)).alias("d"), "_t"))


def _first_misfits(fitting: DataFrame) -> DataFrame:
    """For each source the first rank, in Pareto order, whose words go beyond the gap: ``start`` (null if
    all fit), and ``gap``, what is left of it before.

    ``fitting`` has ``_s``, ``_o``, ``words`` and ``gap``. Words are summed by cells of ranks, the cell
    where the sum passes the gap is cut into cells again until it holds few ranks, and those are
    looked at one by one. So one task never sorts more than ``SORTED`` ranks, however large the source.
    """
    sums = fitting.groupBy("_s").agg(F.sum("words").alias("all"), F.first("gap").alias("gap"))
    inside, before = fitting.withColumn("before", F.lit(0).cast("long")), F.col("before")
    upto = Window.partitionBy("_s").orderBy("cell")
    for level in range(1, LEVELS + 1):
        inside = inside.withColumn("cell", F.floor(F.col("_o.z") * float(CELLS**level)))
        cells = inside.groupBy("_s", "cell").agg(
            F.sum("words").alias("words"), F.count("*").alias("n"), F.first("gap").alias("gap"), F.first("before").alias("before")
        )
        edge = staged(
            cells.withColumn("sum", before + F.sum("words").over(upto))
            .where(F.col("sum") > F.col("gap"))
            .groupBy("_s")
            .agg(F.min(F.struct("cell", (F.col("sum") - F.col("words")).alias("before"), "n")).alias("e"))
            .select("_s", "e.*"),
            "edge",
        )
        inside = inside.drop("before").join(edge.drop("n"), ["_s", "cell"])
        if (edge.agg(F.max("n")).first()[0] or 0) <= SORTED:
            break
    along = Window.partitionBy("_s").orderBy("_o")
    misfit = (
        inside.withColumn("sum", before + F.sum("words").over(along))
        .where(F.col("sum") > F.col("gap"))
        .groupBy("_s")
        .agg(F.min(F.struct("_o", (F.col("sum") - F.col("words")).alias("taken"))).alias("m"))
    )
    return sums.join(misfit, "_s", "left").select(
        "_s", F.col("m._o").alias("start"), (F.col("gap") - F.coalesce("m.taken", "all")).alias("gap")
    )


def _walked(fitting: DataFrame, number: int) -> DataFrame:
    """All further segments of sources with few ranks left: one pass down each source's sorted ranks."""
    place = fitting.schema["_o"].dataType.simpleString()
    start = F.struct(
        F.col("gap"), F.col("gap").alias("limit"), F.array().cast(f"array<struct<round:int,start:{place},gap:double>>").alias("found")
    )

    def step(a: Column, x: Column) -> Column:
        fits, within = x["words"] <= a["gap"], x["words"] <= a["limit"]
        segment = F.struct((F.size(a["found"]) + 1 + number).alias("round"), x["_o"].alias("start"), a["gap"].alias("gap"))
        return F.struct(
            F.when(fits, a["gap"] - x["words"]).otherwise(a["gap"]).alias("gap"),
            F.when(within & ~fits, a["gap"]).otherwise(a["limit"]).alias("limit"),
            F.when(within & ~fits, F.array_append(a["found"], segment)).otherwise(a["found"]).alias("found"),
        )

    ranks = fitting.groupBy("_s").agg(F.array_sort(F.collect_list(F.struct("_o", "words"))).alias("ranks"), F.first("gap").alias("gap"))
    end = F.struct((F.size("w.found") + 1 + number).alias("round"), F.lit(None).cast(place).alias("start"), F.col("w.gap").alias("gap"))
    walked = ranks.select("_s", F.aggregate("ranks", start, step).alias("w"))
    return walked.select("_s", F.explode(F.concat("w.found", F.array(end))).alias("x")).select("_s", "x.*")


def _segments(ranked: DataFrame, rates: DataFrame) -> DataFrame:
    """``_s``, ``round``, ``start``, ``gap``: from ``start`` on, itself left out, ranks of up to ``gap`` words are taken.

    Going down the Pareto order and taking what still fits is done in rounds, all sources at once: a
    round takes ranks up to the first that does not fit, and the next one goes on after it with what
    fits the gap that is left. A misfit is larger than that gap, so gaps fall fast. When no source has
    more than ``WALKED`` ranks left that fit, the rest is one walk each. The last row of a source has
    no start and what stays open as its gap; it is missing where nothing fits any more.
    """
    none = F.lit(None).cast(ranked.schema["_o"].dataType)
    state = rates.where("part > 0").select("_s", F.lit(0).alias("round"), none.alias("start"), F.col("rest").cast("double").alias("gap"))
    out, number = state, 0
    while True:
        fits = (F.col("start").isNull() | (F.col("_o") > F.col("start"))) & (F.col("words") > 0) & (F.col("words") <= F.col("gap"))
        fitting = ranked.join(state, "_s").where(fits).select("_s", "_o", "words", "gap")
        if (fitting.groupBy("_s").count().agg(F.max("count")).first()[0] or 0) <= WALKED:
            return out.unionByName(staged(_walked(fitting, number), "round"))
        number += 1
        found = staged(_first_misfits(fitting).withColumn("round", F.lit(number)), "round")
        out, state = out.unionByName(found), found.where("start is not null")


def _fits(segments: Column, place: Column, words: Column) -> Column:
    """Whether a rank is taken: its segment is the last that starts at or before it."""
    own = F.element_at(F.filter(segments, lambda s: s["start"].isNull() | (s["start"] <= place)), -1)
    return (own["start"].isNull() | (own["start"] < place)) & (words <= own["gap"])


def allocation(docs: DataFrame, seed: int = 11) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sized rows, for each source how its documents are taken, and repeated rows that don't fit together.

    A source whose target is r times its size takes every document floor(r) times for certain. The
    rest is sampled with inclusion probability r - floor(r): documents in the order of their Pareto
    rank, each that fits what is left of the words, then the one document left that brings the words
    nearest to the target. What is missing in the end is less than the smallest document left.
    """
    sized = staged(
        _placed(docs.select("doc_id", "source", "text").withColumn("size", word_count("text")), seed).select(
            "doc_id", "source", "size", "_s", "_t", "_u"
        ),
        "sizes",
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rates = staged(
        source_targets(sized)
        .withColumn("_s", _source_key(F.col("source")))
        .withColumn("whole", F.floor(rate).cast("long"))
        .withColumn("part", rate - F.floor(rate))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .drop("source"),
        "rates",
    )
    ranked = _ranked(sized.select("doc_id", "size", "_s", "_t", "_u"), rates.select("_s", "part")).where("part > 0")
    ranked = staged(ranked.groupBy("_s", "_o").agg(F.sum("size").alias("words"), F.count("*").alias("n")), "ranks")
    rounds = _segments(ranked, rates)
    starts = rounds.where("round = 0 or start is not null").groupBy("_s").agg(
        F.array_sort(F.collect_list(F.struct("round", "start", "gap"))).alias("segments")
    )
    ends = rounds.where("round > 0 and start is null").select("_s", F.col("gap").alias("open"))
    plan = rates.join(starts, "_s", "left").join(ends, "_s", "left")
    judged = ranked.join(plan.select("_s", "segments", F.coalesce("open", F.element_at("segments", -1)["gap"]).alias("open")), "_s")
    left = judged.where(~_fits(F.col("segments"), F.col("_o"), F.col("words")))
    off = F.abs(F.col("words") - F.col("open"))
    closing = left.where(off < F.col("open")).groupBy("_s").agg(F.min(F.struct(off.alias("off"), "_o"))["_o"].alias("closing"))
    single = F.col("words") / F.col("n")
    apart = left.where((F.col("n") > 1) & _fits(F.col("segments"), F.col("_o"), single)).select("_s", "_o", F.lit(True).alias("_apart"))
    return sized, staged(plan.join(closing, "_s", "left"), "allocation"), staged(apart, "apart")


def _copies(rows: DataFrame, plan: DataFrame, apart: DataFrame) -> DataFrame:
    """Add ``copies`` to placed rows with ``size``; a decision rests on the row and its source's plan, and
    on whether the row is one of repeated ones that fit alone but not together."""
    ranked = _ranked(rows, plan.select("_s", "source_size", "target", "whole", "part", "segments", "closing"))
    taken = _fits(F.col("segments"), F.col("_o"), F.col("size"))
    if not apart.isEmpty():
        ranked = ranked.join(apart, ["_s", "_o"], "left")
        taken = taken & F.col("_apart").isNull()
    taken = (F.col("part") > 0) & (taken | F.coalesce(F.col("_o") == F.col("closing"), F.lit(False)))
    return ranked.withColumn("copies", F.col("whole") + F.when(taken, 1).otherwise(0))


def mixture(docs: DataFrame, seed: int = 11) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` for every row of ``docs``.

    ``docs`` needs ``doc_id``, ``source`` and ``text``; other columns are ignored. A null text has no
    words; null is a source of its own, after all others. Rows with the same id and text rank alike
    and are taken together. Sources without words have target 0. Reruns agree: ranks are hashes. An
    empty table gives an empty one.
    """
    sized, plan, apart = allocation(docs, seed)
    return _copies(sized, plan, apart).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed(docs: DataFrame, seed: int = 11) -> DataFrame:
    """The documents of the mix, each as often as it is taken, all columns unchanged."""
    _, plan, apart = allocation(docs, seed)
    placed = _placed(docs.select(whole_row(docs), "doc_id", "source", "text"), seed)
    placed = placed.select("_row", "doc_id", word_count("text").alias("size"), "_s", "_t", "_u")
    taken = _copies(placed, plan, apart).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("copies"))))
    return taken.where("_copy > 0").select("_row.*")
