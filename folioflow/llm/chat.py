"""Chat formatting by multi-party perspective rotation. Columns only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import staged

#: Turns of a rendered part; longer dialogues are rendered in several parts.
PART_TURNS = 64
#: So many parts of a conversation meet its speakers in one group.
PARTS_TOGETHER = 64
END = "<|end|>"
#: Speakers of no perspective: their turns frame the dialogue.
FRAMING = ("system",)


def _spread(df: DataFrame, blocks: int | None = None) -> DataFrame:
    """Rows with ``block``, their place in a total order cut into even blocks, and ``at``, the number
    of the conversation's rows before the block. A conversation of any length is cut among the blocks."""
    parts = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(parts, "_c", "turn", "role", "text").withColumn("block", F.spark_partition_id())
    cut = staged(cut, "turns")
    sizes = cut.groupBy("_c", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("_c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_c", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at"))
    return cut.join(starts, ["_c", "block"])


def numbered(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``role``, ``text``, ``place`` (from 0 in the conversation), by turn, role and text."""
    plain = turns.select("conv_id", "turn", "role", "text").withColumn(
        "_c", F.when(F.col("conv_id").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("conv_id").cast("string")))
    )
    within = Window.partitionBy("_c", "block").orderBy("turn", "role", "text")
    return _spread(plain).withColumn("place", F.col("at") + F.row_number().over(within) - 1).drop("block", "at", "turn")


def _heading(role: Column, speaker: Column) -> Column:
    return (
        F.when(role == speaker, F.lit("<|assistant|>\n"))
        .when(role.isin(*FRAMING), F.concat(F.lit("<|"), role, F.lit("|>\n")))
        .when(role.isNull() | (role == ""), F.lit("<|user|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), _plain(role), F.lit("|>\n")))
    )


def _plain(text: Column) -> Column:
    """Text that can't be taken for a mark of the format."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def perspectives(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """One rendered dialogue for each conversation, participant and part of ``part_turns`` turns.

    Returns ``conv_id``, ``speaker``, ``part`` (from 0), ``n_turns``, ``text``, ``mask`` (what the
    speaker says and the end mark after it, as start:end in code points, comma-joined) and
    ``trained_chars``. The speaker is the assistant, everybody else a user with a name; framing turns
    (system) look the same from everywhere and are nobody's perspective, nor are turns without a
    role, whose user has no name. Turns are ordered by turn, role and text, nulls first; repeated
    rows are said twice; a null text is an empty one; rows with a null conversation are one
    conversation. Marks inside texts are broken up. Other columns are ignored; an empty table gives an
    empty one, and so does a conversation of framing turns. Participants and turns of a long
    conversation are never brought into one group: parts are.
    """
    rows = staged(numbered(turns), "numbered").withColumn("part", F.floor(F.col("place") / part_turns).cast("int"))
    parts = rows.groupBy("_c", "part").agg(
        F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns")
    )
    spoken = F.col("role").isNotNull() & (F.col("role") != "") & ~F.col("role").isin(*FRAMING)
    speakers = rows.where(spoken).select("_c", F.col("role").alias("speaker")).distinct()
    # Speakers are repeated for every PARTS_TOGETHER parts: a join on the conversation alone would bring
    # all of a long one to one task.
    together = rows.groupBy("_c").agg(F.floor(F.max("part") / PARTS_TOGETHER).alias("last"))
    speakers = speakers.join(together, "_c").select("_c", "speaker", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("together"))
    parts = parts.withColumn("together", F.floor(F.col("part") / PARTS_TOGETHER)).join(speakers, ["_c", "together"])
    said = F.transform(
        "turns",
        lambda x: F.struct(
            _heading(x["role"], F.col("speaker")).alias("head"),
            F.concat(_plain(x["text"]), F.lit(END)).alias("body"),
            F.coalesce(x["role"] == F.col("speaker"), F.lit(False)).alias("own"),
        ),
    )
    parts = parts.withColumn("said", said)

    def length(x: Column) -> Column:
        return F.length(x["head"]) + F.length(x["body"]) + 1

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + F.length(x["head"])
        span = F.struct(start.alias("s"), (start + F.length(x["body"])).alias("e"))
        return F.struct(
            (a["at"] + length(x)).alias("at"),
            F.when(x["own"], F.array_append(a["spans"], span)).otherwise(a["spans"]).alias("spans"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("spans"))
    spans = F.aggregate("said", start, step, lambda a: a["spans"])
    return parts.withColumn("spans", spans).select(
        "conv_id",
        "speaker",
        "part",
        F.size("said").alias("n_turns"),
        F.array_join(F.transform("said", lambda x: F.concat(x["head"], x["body"], F.lit("\n"))), "").alias("text"),
        F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["s"].cast("string"), x["e"].cast("string"))), ",").alias("mask"),
        F.aggregate("spans", F.lit(0), lambda a, x: a + x["e"] - x["s"]).alias("trained_chars"),
    )
