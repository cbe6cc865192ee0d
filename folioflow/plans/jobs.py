"""The batch jobs: register guides, register invoices, and the daily run over both."""

from __future__ import annotations

import datetime as dt
import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.names import file_name, relative_to
from folioflow.functions.text import fold_case
from folioflow.operators import guides, invoices
from folioflow.operators.attempts import (
    DEFAULT_MAX_ATTEMPTS, VERSION, attempt_rows, in_circulation, number_attempts, quarantine_rows,
)
from folioflow.operators.listing import distinct_paths, from_day, non_empty, with_effective_time
from folioflow.operators.reconcile import not_registered, pending_guides, pending_invoices
from folioflow.operators.skew import keep_first
from folioflow.plans.lease import RunLease
from folioflow.session import cut_lineage, settle
from folioflow.sinks.files import copy_routed, quarantined_before, quarantined_files, write_quarantine
from folioflow.sinks.registry import GuideRegistry, InvoiceRegistry, first_of_each_file
from folioflow.sources.landing import PDF_FILES, TXT_FILES, XML_FILES, list_files, read_documents
from folioflow.sources.snapshots import GONE, ListingLog


@dataclass(frozen=True)
class Folders:
    pdf: str
    txt: str
    xml: str
    routed: str


def companion_records(spark: SparkSession, folder: str, pdfs: DataFrame) -> DataFrame:
    """Text records of the given PDFs, one for each name compared without case: the first by path.

    Names are matched on the listing, and only the hits are opened.
    """
    needed = guides.with_names(pdfs).select(fold_case(F.col("companion")).alias("_name")).distinct()
    listed = non_empty(list_files(spark, folder, TXT_FILES))
    hits = listed.withColumn("_name", fold_case(file_name(F.col("path")))).join(needed, "_name", "left_semi")
    documents = read_documents(spark, folder, TXT_FILES, keep_first(hits, ["_name"], [F.col("path")]))
    return documents.where("value is not null")


def register_guides(
    registry: GuideRegistry, pdfs: DataFrame, records: DataFrame, as_of: dt.datetime, batch_id: str,
    folders: Folders | None = None, outcomes: str | None = None,
) -> DataFrame:
    """Judge a batch of PDFs and register the accepted ones; returns one outcome row per PDF.

    All checks see the registry as it was before the batch; within the batch the oldest file of a
    guide name wins and the last guide of a delivery stays active. PDFs are copied before
    anything is registered. ``outcomes`` is the folder of the attempt log.
    """
    spark = registry.spark
    seen = registry.last_sequence()
    arrivals = with_effective_time(distinct_paths(non_empty(pdfs)))
    judged = settle(lambda: guides.evaluate(arrivals, records, registry.known))
    if registry.committed(batch_id):
        return judged
    log_attempts(judged, outcomes, batch_id, as_of)

    def picked() -> DataFrame:
        accepted = cut_lineage(guides.first_of_each_guide(judged.where(F.col("status") == "accepted")))
        return accepted if folders is None else copy_routed(spark, accepted, folders.pdf, folders.routed, batch_id)

    # Picked once: the copies, the winner of each delivery and the table all start from these rows.
    accepted = picked() if folders is None else settle(picked)
    registry.append(batch_id, guides.guide_rows(guides.supersede_within(accepted), as_of), as_of, seen)
    return judged


def register_invoices(
    registry: InvoiceRegistry, documents: DataFrame, as_of: dt.datetime, batch_id: str, outcomes: str | None = None
) -> DataFrame:
    """Parse a batch of invoice documents (``path, name_file, value``) and register the valid ones."""
    seen = registry.last_sequence()
    # The documents are looked at twice, for their names and then for what is in them.
    wanted = not_registered(cut_lineage(documents), F.col("name_file"), registry.known)
    return _register_wanted(registry, wanted, as_of, batch_id, seen, outcomes)


def register_landed_invoices(
    registry: InvoiceRegistry, files: DataFrame, folder: str, as_of: dt.datetime, batch_id: str, outcomes: str | None = None
) -> DataFrame:
    """Register the files of a listing. Registered ones go by their names; only the others are opened."""
    seen = registry.last_sequence()
    root = folder_root(registry.spark, folder)
    listed = non_empty(files).withColumn("name_file", relative_to(F.col("path"), root))
    wanted = settle(lambda: not_registered(listed, F.col("name_file"), registry.known))
    return _register_wanted(registry, _documents(registry.spark, folder, wanted, root), as_of, batch_id, seen, outcomes)


def register_changed_invoices(
    registry: InvoiceRegistry, listings: ListingLog, folder: str, as_of: dt.datetime, batch_id: str,
    outcomes: str | None = None,
) -> DataFrame:
    """Register what has landed or been written anew since the last run; all other files are not looked at.

    The change set is committed last: a run that dies is repeated under its batch id on the same files.
    """
    changes = listings.take(batch_id, list_files(registry.spark, folder, XML_FILES))
    files = changes.where(F.col("change") != GONE).drop("change")
    judged = register_landed_invoices(registry, files, folder, as_of, batch_id, outcomes)
    if not listings.committed(batch_id):
        listings.commit(batch_id, as_of)
    return judged


def _documents(spark: SparkSession, folder: str, wanted: DataFrame, root: str) -> DataFrame:
    return read_documents(spark, folder, XML_FILES, wanted, *VERSION).withColumn("name_file", relative_to(F.col("path"), root))


def _register_wanted(
    registry: InvoiceRegistry, documents: DataFrame, as_of: dt.datetime, batch_id: str, seen: int,
    outcomes: str | None = None,
) -> DataFrame:
    judged = cut_lineage(invoices.evaluate(documents))
    if not registry.committed(batch_id):
        log_attempts(judged, outcomes, batch_id, as_of)
        registry.append(batch_id, first_of_each_file(judged.where(F.col("status") == "accepted")), as_of, seen)
    return judged


def log_attempts(judged: DataFrame, folder: str | None, batch_id: str, as_of: dt.datetime) -> None:
    if folder is not None:
        attempt_rows(judged, batch_id, as_of).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def quarantine(
    spark: SparkSession, outcomes: str, target: str, batch_id: str, max_attempts: int = DEFAULT_MAX_ATTEMPTS
) -> DataFrame:
    """Count the attempts of the whole log and write the files that failed too often, each once.

    What an earlier run stored is left out; returns what this run stores. A batch id may run again.
    """
    schema = (
        "path string, ts timestamp_ntz, attempt_id string, success boolean, error string, "
        "modificationTime timestamp_ntz, length long"
    )
    rows = quarantine_rows(number_attempts(spark.read.schema(schema).parquet(f"{outcomes}/batch=*"), max_attempts))
    rows = cut_lineage(rows.join(quarantined_before(spark, target, batch_id), "attempt_id", "left_anti"))
    write_quarantine(rows, target, batch_id)
    return rows


class DailyRun:
    """The daily reconciliation. A run that finds another one active does nothing.

    ``outcomes`` and ``dead_letters`` are the folders of the attempt log and of the quarantine, both with a part
    per pipeline. With them a run logs its attempts, passes over the files in quarantine, and puts there
    what has failed too often; such a file is tried again once it has been written anew.

    ``lease`` keeps runs of other processes out. It is renewed at each commit, so a run that was taken over shows
    nothing it had not committed before.
    """

    def __init__(self, spark: SparkSession, folders: Folders, guide_registry: GuideRegistry,
                 invoice_registry: InvoiceRegistry, outcomes: str | None = None, dead_letters: str | None = None,
                 max_attempts: int = DEFAULT_MAX_ATTEMPTS, lease: RunLease | None = None):
        if dead_letters is not None and outcomes is None:
            raise ValueError("the quarantine is filled from the attempt log: name its folder too")
        self.outcomes = outcomes
        self.dead_letters = dead_letters
        self.max_attempts = max_attempts
        self.lease = lease
        self.spark = spark
        self.folders = folders
        self.guide_registry = guide_registry
        self.invoice_registry = invoice_registry
        self._active = threading.Lock()

    def run(
        self, as_of: dt.datetime, only_today: bool = False, max_files: int | None = None,
        skip_registered: bool = True, pipelines: tuple[str, ...] = ("guide", "invoice"),
    ) -> DataFrame | None:
        """One summary row per pipeline; a pipeline that breaks does not stop the other."""
        if not self._active.acquire(blocking=False):
            return None
        registries = (self.guide_registry, self.invoice_registry)
        try:
            if self.lease is not None:
                if self.lease.take() is None:
                    return None
                for registry in registries:
                    registry.guard = self.lease.renew
            rows = []
            for name in pipelines:
                step = {"guide": self._guides, "invoice": self._invoices}[name]
                try:
                    rows.append((name, *step(as_of, only_today, max_files, skip_registered), None))
                    self._quarantine(name, as_of)
                except Exception as error:  # noqa: BLE001 - reported in the summary
                    rows.append((name, None, None, None, str(error)))
            return self.spark.createDataFrame(
                rows, "pipeline string, pending long, processed long, failed long, error string"
            )
        finally:
            if self.lease is not None:
                for registry in registries:
                    registry.guard = None
                self.lease.release()
            self._active.release()

    def _part(self, folder: str | None, pipeline: str) -> str | None:
        return None if folder is None else f"{folder.rstrip('/')}/{pipeline}"

    def _quarantine(self, pipeline: str, as_of: dt.datetime) -> None:
        if self.dead_letters is not None:
            log, target = self._part(self.outcomes, pipeline), self._part(self.dead_letters, pipeline)
            quarantine(self.spark, log, target, f"{as_of:%Y%m%dT%H%M%S}", self.max_attempts)

    def _candidates(self, pipeline: str, folder: str, glob: str, as_of: dt.datetime, only_today: bool) -> DataFrame:
        listed = list_files(self.spark, folder, glob)
        if self.dead_letters is not None:
            listed = in_circulation(listed, quarantined_files(self.spark, self._part(self.dead_letters, pipeline)))
        return from_day(listed, as_of.date()) if only_today else listed

    def _guides(self, as_of, only_today, max_files, skip_registered):
        listed = self._candidates("guide", self.folders.pdf, PDF_FILES, as_of, only_today)
        known = self.guide_registry.known if skip_registered else self.guide_registry.keys().limit(0)
        pending = settle(lambda: pending_guides(listed, known, max_files))
        judged = register_guides(
            self.guide_registry, pending.drop("guide_key", "effective_time"),
            companion_records(self.spark, self.folders.txt, pending.drop("guide_key")),
            as_of, f"daily-guide-{as_of:%Y%m%dT%H%M%S}", self.folders, self._part(self.outcomes, "guide"),
        )
        return self._counts(pending, judged)

    def _invoices(self, as_of, only_today, max_files, skip_registered):
        seen = self.invoice_registry.last_sequence()
        listed = self._candidates("invoice", self.folders.xml, XML_FILES, as_of, only_today)
        known = self.invoice_registry.known if skip_registered else self.invoice_registry.headers().limit(0)
        root = folder_root(self.spark, self.folders.xml)
        pending = settle(lambda: pending_invoices(listed, known, root, max_files))
        documents = _documents(self.spark, self.folders.xml, pending, root)
        judged = _register_wanted(
            self.invoice_registry, documents, as_of, f"daily-invoice-{as_of:%Y%m%dT%H%M%S}", seen,
            self._part(self.outcomes, "invoice"),
        )
        return self._counts(pending, judged)

    @staticmethod
    def _counts(pending: DataFrame, judged: DataFrame) -> tuple[int, int, int]:
        failed = judged.where(F.col("status") == "failed").count()
        total = pending.count()
        return total, total - failed, failed


def folder_root(spark: SparkSession, folder: str) -> str:
    """The folder as Spark spells it in file paths."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(path).toString()
