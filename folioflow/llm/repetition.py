"""Stretches of a text in which the same words come round again and again, and texts without the repeats.

A run of period q is a stretch whose words equal the words q places on, so on the diagonal of lag q it is a
row of at least ``max(least - q, (times - 1) * q)`` matches. The runs are found by seed and extend: k-grams
that are never longer than the matches guaranteed at their lags are indexed, neighbouring occurrences in a
document give seeds, and a seed is extended both ways unless its lag is covered there already.

A gram no shorter than the period can't come again inside the run before one period has gone by, so the
nearest occurrence is at the run's own lag. Hence the seeds are neighbours only, never all pairs: lags up to
the first k are met by grams of that length, lags of (k / 2, k] by grams of each following power of two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import Batches, frugal, words_of

#: A run has so many words, and its period fits in so many times.
LEAST, TIMES = 24, 3
#: Bytes of text that are looked at together; a longer text is looked at alone.
BYTES_AT_ONCE = 2_000_000

_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def seed_length(least: int, times: int) -> int:
    """The longest power of two that no run's row of matches falls short of."""
    if times < 3:
        raise ValueError("runs hold their period at least three times")
    shortest = min(max(least - q, (times - 1) * q) for q in range(1, max(2, least) + 1))
    return 1 << (max(1, shortest).bit_length() - 1)


def _forward(words: np.ndarray, at: int, lag: int) -> int:
    """How many words from ``at`` on equal those ``lag`` places on."""
    met, step = 0, 64
    while True:
        there = words[at + met + lag : at + met + lag + step]
        other = np.flatnonzero(words[at + met : at + met + len(there)] != there)
        if len(other):
            return met + int(other[0])
        met += len(there)
        if len(there) < step:
            return met
        step *= 2


def seeds(words: np.ndarray, first: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``k`` and rows of seeds: lag, first and last place where a k-gram comes again at that lag next.

    Grams get numbers by doubling: a gram of 2k words is a pair of grams of k words. Only places whose gram
    comes more than once are looked at again.
    """
    number = words.copy()
    _, inverse, counts = np.unique(words, return_inverse=True, return_counts=True)
    alive = np.flatnonzero(counts[inverse] > 1)
    number[:] = -1
    number[alive] = inverse[alive]
    k = 1
    while len(alive):
        if k >= first:
            order = np.argsort(number[alive], kind="stable")
            at, gram = alive[order], number[alive[order]]
            lag = at[1:] - at[:-1]
            wanted = (gram[1:] == gram[:-1]) & (lag <= k) & (lag > (0 if k == first else k // 2))
            at, lag = at[:-1][wanted], lag[wanted]
            order = np.lexsort((at, lag))
            at, lag = at[order], lag[order]
            # Seeds in a row are one piece of their diagonal.
            opens = np.flatnonzero(np.r_[True, (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)]) if len(at) else at
            closes = np.r_[opens[1:], len(at)] - 1 if len(at) else at
            yield k, lag[opens], at[opens], at[closes]
        follows = alive[alive + k < len(number)]
        follows = follows[number[follows + k] >= 0]
        pairs = number[follows] * np.int64(len(number)) + number[follows + k]
        _, inverse, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        again = counts[inverse] > 1
        number[alive] = -1
        alive = follows[again]
        number[alive] = inverse[again]
        k *= 2


def runs_of(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of every run of a sequence of numbers."""
    out = []
    covered: dict[int, int] = {}
    backward = words[::-1]
    for k, lags, firsts, lasts in seeds(words, seed_length(least, times)):
        for lag, first, last in zip(lags.tolist(), firsts.tolist(), lasts.tolist()):
            if first < covered.get(lag, 0):
                continue
            end = last + k + _forward(words, last + k, lag)
            begin = first - _forward(backward, len(words) - first - lag, lag)
            covered[lag] = end
            if end - begin + lag >= max(least, times * lag):
                out.append((begin, end - begin + lag, lag))
    return out


def _word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, and where each text's begin."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, ends = lists.flatten(), np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]
    full = pc.greater(pc.binary_length(words), 0)
    so_far = np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False))]
    return words.filter(full), so_far[ends]


def _looked_at(texts: pa.Array, least: int, times: int) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of each text. All go through as one sequence, with a number that occurs
    once between any two texts, so nothing matches across."""
    words, offsets = _word_lists(texts)
    sizes = np.diff(offsets)
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(words)) + text_of + 1
    borders = offsets + np.arange(len(offsets))
    sequence = np.empty(len(words) + len(offsets), np.int64)
    # A word of another text is another word: what only comes again there is no seed.
    sequence[place] = text_of * (codes.max(initial=0) + 1) + codes
    sequence[borders] = -1 - np.arange(len(offsets))
    found = np.array(runs_of(sequence, least, times), np.int64).reshape(-1, 3)
    owner = np.searchsorted(borders, found[:, 0], side="right") - 1
    begin = found[:, 0] - borders[owner] - 1
    order = np.lexsort((found[:, 2], begin, owner))
    fields = [pa.array(column[order]) for column in (begin, found[:, 1], found[:, 2])]
    runs = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(owner[order], np.arange(len(offsets))).astype(np.int32)),
        pa.StructArray.from_arrays(fields, ["start", "length", "period"]),
    )
    change = np.zeros(len(sequence) + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(change)[place] == 0
    if not kept.all():
        words = words.filter(pa.array(kept))
        offsets = np.r_[0, np.cumsum(kept)][offsets]
    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), words)
    return runs, pc.binary_join(lists, " ")


def found(documents: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``doc_id``, ``runs`` (array of start, length, period, by start and then period), ``collapsed`` of every row.

    A run is a stretch of words with smallest period q, of at least ``max(least, times * q)`` words, that no
    word beside it carries on. ``collapsed`` is the text without the words that some run holds after its
    first q, the others joined by one blank. Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text; null and
    empty texts have no runs and an empty collapsed text. Rows stay as many as they are, with their ids,
    null or repeated, as they come; other columns are ignored. A text stays in its row, so rows are never
    brought together, and takes memory in proportion to its own length.
    """
    seed_length(least, times)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:
                together = int(np.searchsorted(np.cumsum(sizes[at:]), BYTES_AT_ONCE, side="right"))
                some = batch.slice(at, max(1, together))
                at += some.num_rows
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), *_looked_at(some.column(1), least, times)], ["doc_id", "runs", "collapsed"]
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(frugal(run), f"doc_id {kind}, runs {_RUNS}, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """One row per document: how many runs, the one that repeats most often, and digests of runs and text."""
    runs = F.col("runs")
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")

    def better(best: Column, run: Column) -> Column:
        # By length over period as whole numbers; runs come by start and period, so the first of equals stays.
        more = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(more, run).otherwise(best)

    spelt = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", F.aggregate(runs, none, better)).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"), F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(spelt, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted(documents: DataFrame) -> DataFrame:
    """Documents whose id's CRC-32 is divisible by ten get a periodic end: from word ``a`` on, the ``p`` words
    there come again until the text is as long as it was. Null ids and texts without words stay as they are.
    """
    check = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(check / 10).cast("long")
    rows = documents.select("doc_id", "text", check.alias("_h"), g.alias("_g"))
    chosen = (F.col("_h") % 10 == 0) & F.col("text").isNotNull()
    rows = rows.withColumn("_words", F.when(chosen, words_of("text"))).withColumn("_n", F.size("_words").cast("long"))
    rows = rows.withColumn("_from", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    rest = F.col("_n") - F.col("_from")
    rows = rows.withColumn("_p", F.floor(rest / (3 + F.col("_g") % 8)).cast("long") + 1)
    # The words from "_from" on, laid out as often as they reach the end, and cut there.
    piece = F.slice("_words", (F.col("_from") + 1).cast("int"), F.col("_p").cast("int"))
    laid = F.flatten(F.array_repeat(piece, F.ceil(rest / F.col("_p")).cast("int")))
    whole = F.slice(F.concat(F.slice("_words", F.lit(1), F.col("_from").cast("int")), laid), F.lit(1), F.col("_n").cast("int"))
    return rows.select("doc_id", F.when(F.col("_from").isNotNull(), F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


