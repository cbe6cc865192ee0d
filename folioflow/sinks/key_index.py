"""Registered keys laid out for batches: a small batch reads a little of them, however many there are.

Keys are sorted by a hash, so that a part of them is a few row groups, next to a Bloom sketch: 64-bit words of bits,
as rows. A batch first looks up its own bits in the sketch, about a byte and a quarter for each registered key;
only keys that may be there are then looked for, where their hashes lie. The batch's keys are sent to the tasks and
the registry is filtered in place, so it is never shuffled. A batch that is too large to be sent gets all keys back
and joins them as tables are joined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import fold_case, is_blank
from folioflow.session import cut_lineage
from folioflow.sinks.ledger import Ledger

#: Parts of the keys, and 64-bit words of a part's sketch. Fixed for a registry, as its rows are placed by them. More
#: keys than about six to a word make the sketch say "maybe" more often; the answers stay right.
PREFIXES, WORDS = 4096, 1 << 14
#: Bits a key sets.
BITS = 4
#: Keys of a batch that are sent to the tasks at most. They pass through the driver, each with the rows of its bits.
MOST_SENT = 50_000

#: Gives the registered ones among some keys: ``registered_key``.
Lookup = Callable[[DataFrame], DataFrame]


def prefix_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(PREFIXES)).cast("int")


def _bits(keys: DataFrame) -> DataFrame:
    """The bits of every key: ``key, prefix, word, mask``."""
    each = keys.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(BITS))))
    placed = each.withColumn("_at", F.pmod(F.xxhash64("_n", "key"), F.lit(64 * WORDS)))
    return placed.selectExpr(
        "key", "prefix", "cast(_at div 64 as int) as word", "shiftleft(1L, cast(_at % 64 as int)) as mask"
    )


#: Tables a ledger needs for it.
INDEX_TABLES = {"names": "key string, prefix int", "sketch": "prefix int, word int, mask long"}


class KeyIndex(Ledger):
    """A ledger with a table of keys, ``names``, and their sketch."""

    def write_names(self, batch_id: str, names: DataFrame) -> None:
        """Add the keys of a batch (one column, any case) to its directories; the batch's commit shows them."""
        keys = names.select(fold_case(F.col(names.columns[0])).alias("key")).where(~is_blank(F.col("key"))).distinct()
        keys = keys.withColumn("prefix", prefix_of(F.col("key")))
        self.write("names", batch_id, keys.repartition("prefix").sortWithinPartitions("prefix", "key"))
        sketch = _bits(self.written("names", batch_id)).groupBy("prefix", "word").agg(F.bit_or("mask").alias("mask"))
        self.write("sketch", batch_id, sketch.repartition("prefix").sortWithinPartitions("prefix", "word"))

    def names(self) -> DataFrame:
        """All registered keys, folded: ``key``, ``prefix``."""
        return self.stored("names")

    def known(self, candidates: DataFrame) -> DataFrame:
        """``registered_key``, distinct: the registered ones among the candidates' keys (one column, folded).

        All registered keys come back for more candidates than can be sent to the tasks.
        """
        column = F.col(candidates.columns[0])
        wanted = candidates.select(column.alias("key")).where(~is_blank(F.col("key"))).distinct()
        wanted = cut_lineage(wanted.withColumn("prefix", prefix_of(F.col("key"))))
        asked = wanted.agg(F.count("*").alias("keys"), F.collect_set("prefix").alias("parts")).first()
        if asked["keys"] > MOST_SENT:
            return self.names().select(F.col("key").alias("registered_key")).distinct()
        maybe = cut_lineage(self._maybe(wanted, asked["parts"]))
        parts = maybe.agg(F.collect_set("prefix").alias("parts")).first()["parts"]
        found = _parts(self.names(), parts).join(F.broadcast(maybe), ["prefix", "key"], "left_semi")
        return F.broadcast(found.select(F.col("key").alias("registered_key")).distinct())

    def _maybe(self, wanted: DataFrame, parts: list[int]) -> DataFrame:
        """Candidates whose bits are all set; of the others none is registered."""
        bits = _bits(wanted).withColumnRenamed("mask", "bit")
        sketch = _parts(self.stored("sketch"), parts)
        hit = sketch.join(F.broadcast(bits), ["prefix", "word"]).where(F.col("mask").bitwiseAND(F.col("bit")) != 0)
        asked = bits.groupBy("prefix", "key").agg(F.count_distinct("word", "bit").alias("asked"))
        met = hit.groupBy("prefix", "key").agg(F.count_distinct("word", "bit").alias("met"))
        return met.join(asked, ["prefix", "key"]).where("met = asked").select("prefix", "key")


def _parts(rows: DataFrame, parts: list[int]) -> DataFrame:
    """Rows of some parts: at most ``PREFIXES`` numbers, pushed into the scan."""
    return rows.where(F.col("prefix").isin(parts))
