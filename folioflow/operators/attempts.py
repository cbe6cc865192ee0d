"""Processing attempts: counting failures in a row, and what goes to quarantine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.names import file_name
from folioflow.functions.text import fold_case
from folioflow.functions.times import moment
from folioflow.operators.skew import in_blocks, mark_winner, run_length

DEFAULT_MAX_ATTEMPTS = 3

#: What tells one version of a file from the next.
VERSION = ["modificationTime", "length"]


def attempt_rows(judged: DataFrame, batch_id: str, as_of: dt.datetime) -> DataFrame:
    """Outcomes of a job run as attempts; skipped files count as handled.

    An attempt names the version of the file it was made on, null where the job doesn't know it.
    """
    kinds = dict(zip(VERSION, ("timestamp_ntz", "long")))
    return judged.select(
        "path",
        moment(as_of).alias("ts"),
        F.concat(F.lit(f"{batch_id}/"), F.col("path")).alias("attempt_id"),
        (F.col("status") != "failed").alias("success"),
        F.col("reason").alias("error"),
        *(
            (F.col(name) if name in judged.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in kinds.items()
        ),
    )


def number_attempts(
    outcomes: DataFrame, max_attempts: int = DEFAULT_MAX_ATTEMPTS, blocks: int | None = None
) -> DataFrame:
    """Failed attempts with their ``attempts`` count and whether they end in ``quarantined``.

    ``outcomes`` holds ``path, ts, attempt_id, success, error``. The count runs per path (without
    case), a success resets it and so does the move to quarantine. ``blocks`` is the number of
    pieces the ordered attempts are cut into, by default the session's shuffle partitions.
    """
    limit = max(1, max_attempts)
    keyed = outcomes.withColumn("_path", fold_case(F.col("path")))
    blocks = in_blocks(keyed, ["_path", "ts", "attempt_id"], blocks)
    counted = run_length(blocks, "_path", ["ts", "attempt_id"], F.col("success"), "_failures")
    return (
        counted.where(~F.col("success"))
        .withColumn("attempts", ((F.col("_failures") - 1) % limit + 1).cast("int"))
        .withColumn("quarantined", F.col("attempts") == limit)
        .drop("_path", "_failures", "block")
    )


def quarantine_rows(numbered: DataFrame, enabled: bool = True) -> DataFrame:
    """Dead-letter rows: day, name in the day's folder, source path, attempts and error.

    The first file of a name keeps it within a day; later ones get the time of day inserted
    before the extension. The version of the file is kept where the attempts name it.
    """
    version = [name for name in VERSION if name in numbered.columns]
    ended = numbered.where(F.col("quarantined") & F.lit(enabled)).select(
        F.to_date("ts").alias("day"), file_name(F.col("path")).alias("_name"), "path", "ts", "attempt_id",
        "attempts", "error", *version,
    )
    named = ended.where(F.col("_name") != "").withColumn("_key", fold_case(F.col("_name")))
    marked = mark_winner(named, ["day", "_key"], [F.col("ts"), F.col("attempt_id")], "attempt_id", "_first")
    extension = F.regexp_extract("_name", r"\.[^.]*\z", 0)
    stem = F.left(F.col("_name"), F.length("_name") - F.length(extension))
    return marked.select(
        "day",
        F.when(F.col("_first"), F.col("_name"))
        .otherwise(F.concat(stem, F.lit("."), F.date_format("ts", "HHmmssSSS"), extension))
        .alias("stored_as"),
        "path", "attempt_id", "attempts", "error", F.col("ts").alias("failed_at"), *version,
    )


def in_circulation(listing: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Listed files but for those that are in quarantine as they are now.

    ``quarantined`` holds ``path, modificationTime, length`` of dead-letter rows. A file that has been written
    again since, with another write time or length, is a new version and gets its attempts anew. Dead letters
    of an unknown version hold nothing back. Paths are compared without case and each is one key, so no
    key is hot; both sides are reduced to what the join looks at.
    """
    held = quarantined.select(fold_case(F.col("path")).alias("_path"), *VERSION).distinct()
    return listing.withColumn("_path", fold_case(F.col("path"))).join(held, ["_path", *VERSION], "left_anti").drop("_path")
