"""What has landed against what is registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.names import file_name, guide_key_from_pdf, relative_to
from folioflow.functions.text import fold_case, is_blank
from folioflow.operators.listing import oldest_first, with_effective_time
from folioflow.operators.skew import spread_nulls


#: Registered keys (``registered_key``), or what finds the registered ones among some keys.
Keys = DataFrame | Callable[[DataFrame], DataFrame]


def registered_keys(registered: DataFrame, column: str) -> DataFrame:
    """Distinct case-folded keys of a registered table; the scan reads that one column."""
    return (
        registered.select(fold_case(F.col(column)).alias("registered_key"))
        .where(~is_blank(F.col("registered_key")))
        .distinct()
    )


def _among(candidates: DataFrame, key: Column, keys: Keys) -> DataFrame:
    return keys(candidates.select(fold_case(key).alias("key"))) if callable(keys) else keys


def mark_registered(candidates: DataFrame, key: Column, keys: Keys, row_id: str = "path") -> DataFrame:
    """Add ``registered``; candidates without a key are never registered."""
    keys = _among(candidates, key, keys)
    return (
        candidates.withColumn("_key", spread_nulls(fold_case(key), F.col(row_id)))
        .join(keys.withColumn("registered", F.lit(True)), F.col("_key") == F.col("registered_key"), "left")
        .withColumn("registered", F.coalesce("registered", F.lit(False)))
        .drop("_key", "registered_key")
    )


def not_registered(candidates: DataFrame, key: Column, keys: Keys, row_id: str = "path") -> DataFrame:
    """Candidates whose key is not registered; those without a key pass."""
    keys = _among(candidates, key, keys)
    return (
        candidates.withColumn("_key", spread_nulls(fold_case(key), F.col(row_id)))
        .join(keys, F.col("_key") == F.col("registered_key"), "left_anti")
        .drop("_key")
    )


def with_guide_keys(listing: DataFrame) -> DataFrame:
    return listing.withColumn("guide_key", guide_key_from_pdf(file_name(F.col("path"))))


def pending_guides(
    listing: DataFrame,
    registered: Keys,
    max_files: int | None = None,
    limit_after: bool = False,
    active_only: bool = False,
) -> DataFrame:
    """PDFs to process: the oldest of them, if there is a limit, without those whose guide key is registered.

    ``registered`` is a guide table or a registry's ``known``. A limit, if there is one, applies before the registered guides are taken out, so a backlog of
    registered files can hide newer ones; ``limit_after`` turns the two around. Voided guides still count
    as registered unless ``active_only``.
    """
    if active_only:
        registered = registered.where(~F.col("Auditoria_Deleted"))
    keys = registered if callable(registered) else registered_keys(registered, "greName")
    if limit_after:
        return _oldest(not_registered(with_guide_keys(listing), F.col("guide_key"), keys), max_files)
    return not_registered(with_guide_keys(_oldest(listing, max_files)), F.col("guide_key"), keys)


def _oldest(listing: DataFrame, max_files: int | None) -> DataFrame:
    # Without a limit there is nothing to sort for: what follows looks at files in any order.
    return with_effective_time(listing) if max_files is None else oldest_first(listing, max_files)


def pending_invoices(
    listing: DataFrame, registered: Keys, root: str, max_files: int | None = None
) -> DataFrame:
    """Invoice files to process: the oldest, if there is a limit, without those whose relative path is registered."""
    named = _oldest(listing, max_files).withColumn("name_file", relative_to(F.col("path"), root))
    keys = registered if callable(registered) else registered_keys(registered, "NameFile")
    return not_registered(named, F.col("name_file"), keys)


def work_list(guides: DataFrame, invoices: DataFrame) -> DataFrame:
    """Pending files of both kinds in one list."""
    columns = ["path", "effective_time"]
    return guides.select(F.lit("guide").alias("source"), *columns).unionByName(
        invoices.select(F.lit("invoice").alias("source"), *columns)
    )


def run_counters(marked: DataFrame, key: str) -> DataFrame:
    """Counters of one reconciliation run over candidates marked as registered or not."""
    registered = F.col("registered")
    return marked.agg(
        F.count("*").alias("candidates"),
        F.count_if(registered).alias("already_registered"),
        F.count_if(F.col(key).isNull()).alias("no_key"),
        F.count_if(~registered).alias("pending"),
    )


def outcome_counters(outcomes: DataFrame) -> DataFrame:
    """Processed and failed files of a run; a skipped file counts as processed."""
    return outcomes.agg(
        F.count_if(F.col("status") != "failed").alias("processed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
