"""Continuous ingestion: every micro-batch of landed files goes through the batch jobs.

Batch ids are ``<stream name>-<micro-batch number>``; a repeated micro-batch finds its id
committed and adds nothing. A stream started on a fresh checkpoint needs a fresh name.
"""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from folioflow.functions.names import file_name
from folioflow.functions.text import fold_case
from folioflow.operators.guides import pdfs_of_arrived_records
from folioflow.operators.listing import non_empty
from folioflow.operators.skew import keep_first
from folioflow.plans.jobs import Folders, companion_records, register_guides, register_landed_invoices
from folioflow.session import cut_lineage
from folioflow.sinks.registry import GuideRegistry, InvoiceRegistry
from folioflow.sources.landing import (
    PDF_FILES, TXT_FILES, XML_FILES, list_files, read_documents, stream_files, stream_listing,
)
from folioflow.sources.stores import reachable
from folioflow.streaming.matching import matched_records

Clock = Callable[[], dt.datetime]

_WATERMARKS = "spark.sql.streaming.multipleWatermarkPolicy"


def _start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _landed(
    spark: SparkSession, folder: str, glob: str, checkpoint: str, kind: str, max_files: int, every: str | None
) -> DataFrame:
    """The files of a folder as a stream. One that takes what is there and ends has its listing made by tasks;
    one that goes on watching has Spark's file source list the folder on the driver each time."""
    if every is None and reachable(folder):
        return stream_listing(spark, folder, glob, f"{checkpoint}/arrivals/{kind}", max_files)
    return stream_files(spark, folder, glob, max_files)


def guides_from_pdfs(
    registry: GuideRegistry, folders: Folders, checkpoint: str, clock: Clock, name: str = "pdf",
    max_files: int = 2000, every: str | None = None, outcomes: str | None = None,
) -> StreamingQuery:
    """Register guides as their PDFs land; ``outcomes`` is the folder of the attempt log."""
    spark = registry.spark

    def batch(files: DataFrame, number: int) -> None:
        pdfs = cut_lineage(files)
        register_guides(
            registry, pdfs, companion_records(spark, folders.txt, pdfs), clock(), f"{name}-{number}", folders, outcomes
        )

    stream = _landed(spark, folders.pdf, PDF_FILES, checkpoint, "pdf", max_files, every)
    return _start(stream.writeStream.foreachBatch(batch), checkpoint, every)


def guides_from_records(
    registry: GuideRegistry, folders: Folders, checkpoint: str, clock: Clock, name: str = "txt",
    max_files: int = 2000, every: str | None = None,
) -> StreamingQuery:
    """Look again at the PDFs whose text record has just landed. Failures here are not quarantined."""
    spark = registry.spark

    def batch(files: DataFrame, number: int) -> None:
        landed = list_files(spark, folders.pdf, PDF_FILES)
        pdfs = cut_lineage(pdfs_of_arrived_records(non_empty(files), landed).drop("guide_key", "companion", "txt_name"))
        register_guides(
            registry, pdfs, companion_records(spark, folders.txt, pdfs), clock(), f"{name}-{number}", folders
        )

    stream = _landed(spark, folders.txt, TXT_FILES, checkpoint, "txt", max_files, every)
    return _start(stream.writeStream.foreachBatch(batch), checkpoint, every)


@contextlib.contextmanager
def newest_watermark(spark: SparkSession) -> Iterator[None]:
    """Start queries inside whose streams share one clock: a stream that is silent doesn't hold up the others."""
    before = spark.conf.get(_WATERMARKS)
    spark.conf.set(_WATERMARKS, "max")
    try:
        yield
    finally:
        spark.conf.set(_WATERMARKS, before)


def guides_from_pairs(
    registry: GuideRegistry, folders: Folders, checkpoint: str, clock: Clock, name: str = "pair", within: str = "1 day",
    max_files: int = 2000, every: str | None = None, outcomes: str | None = None,
) -> StreamingQuery:
    """Register guides as soon as a PDF and its text record have both landed, whichever comes first.

    In place of :func:`guides_from_pdfs` and :func:`guides_from_records`: PDFs wait in the state, no folder is listed
    again, and only the records that met a PDF are opened. A file counts from when the stream saw it. PDFs whose
    record is not there ``within`` that time are judged without; the daily run looks at them again.
    """
    spark = registry.spark

    def batch(rows: DataFrame, number: int) -> None:
        met = cut_lineage(rows)
        pdfs = met.select("path", "modificationTime", "creation_time", "length").distinct()
        landed = met.where("record is not null").select("record.*").withColumn("_name", fold_case(file_name(F.col("path"))))
        wanted = keep_first(landed, ["_name"], [F.col("path")])
        records = read_documents(spark, folders.txt, TXT_FILES, wanted).where("value is not null")
        register_guides(registry, pdfs, records, clock(), f"{name}-{number}", folders, outcomes)

    # The time of the micro-batch, the same when it is repeated.
    pdfs = non_empty(_landed(spark, folders.pdf, PDF_FILES, checkpoint, "pdf", max_files, every)).withColumn("arrived_at", F.current_timestamp())
    records = non_empty(_landed(spark, folders.txt, TXT_FILES, checkpoint, "txt", max_files, every)).select(
        "path", F.current_timestamp().alias("arrived_at"), F.struct("path", "modificationTime", "length").alias("record")
    )
    with newest_watermark(spark):
        stream = matched_records(pdfs, records, within)
        return _start(stream.writeStream.foreachBatch(batch), checkpoint, every)


def invoices_from_files(
    registry: InvoiceRegistry, folders: Folders, checkpoint: str, clock: Clock, name: str = "xml",
    max_files: int = 2000, every: str | None = None, outcomes: str | None = None,
) -> StreamingQuery:
    """Register invoices as their XML files land; ``outcomes`` is the folder of the attempt log."""
    spark = registry.spark

    def batch(files: DataFrame, number: int) -> None:
        register_landed_invoices(registry, cut_lineage(files), folders.xml, clock(), f"{name}-{number}", outcomes)

    stream = _landed(spark, folders.xml, XML_FILES, checkpoint, "xml", max_files, every)
    return _start(stream.writeStream.foreachBatch(batch), checkpoint, every)


def distinct_arrivals(arrivals: DataFrame, time: str = "modificationTime", within: str = "1 hour") -> DataFrame:
    """A stream's first arrival of each path (without case); state is kept for ``within``."""
    return (
        arrivals.withColumn("path_key", fold_case(F.col("path")))
        .withWatermark(time, within)
        .dropDuplicatesWithinWatermark(["path_key"])
        .drop("path_key")
    )
