"""Contents of exactly the files a listing names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.session import cut_lineage
from folioflow.sources.stores import FAILURES, Stores, as_text

#: Files and bytes a task should read, and those it hands on at a time. A larger file makes a task of its own.
TASK_FILES, TASK_BYTES = 4_000, 128 << 20
BATCH_FILES, BATCH_BYTES = 256, 16 << 20


def dealt_out(wanted: DataFrame) -> DataFrame:
    """The listed files over as many tasks as their number and bytes ask for, each task with like shares.

    A listing is a few partitions whatever it lists, so the work would not spread by itself. It is written down first:
    counting its rows and dealing them out would each make them anew.
    """
    wanted = cut_lineage(wanted)
    size = F.col("length") if "length" in wanted.columns else F.lit(0)
    total = wanted.agg(F.count("*").alias("files"), F.sum(size).alias("bytes")).first()
    tasks = 1 + max(total["files"] // TASK_FILES, (total["bytes"] or 0) // TASK_BYTES)
    cores = wanted.sparkSession.sparkContext.defaultParallelism
    return wanted.repartition(max(tasks, min(cores, max(1, total["files"] // BATCH_FILES))))


def _opened(wanted: DataFrame, kind: str, convert: Callable[[bytes], bytes | str], extra: tuple[str, ...]) -> DataFrame:
    column, arrow = {"binary": ("content", pa.binary()), "string": ("value", pa.string())}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores = Stores()
        for batch in batches:
            start, size = 0, 0
            values: list[bytes | str | None] = []
            errors: list[str | None] = []

            def part(start: int, values: list, errors: list) -> pa.RecordBatch:
                rows = batch.slice(start, len(values))
                columns = [rows.column(0), pa.array(values, arrow), pa.array(errors, pa.string()), *rows.columns[1:]]
                return pa.RecordBatch.from_arrays(columns, ["path", column, "error", *extra])

            for path in batch.column(0).to_pylist():
                try:
                    with stores.open(path) as file:
                        raw = file.read()
                    value, error = convert(raw), None
                    size += len(raw)
                except FAILURES as failure:
                    value, error = None, f"{type(failure).__name__}: {failure}"
                values.append(value)
                errors.append(error)
                if len(values) >= BATCH_FILES or size >= BATCH_BYTES:
                    yield part(start, values, errors)
                    start, size, values, errors = start + len(values), 0, [], []
            if values:
                yield part(start, values, errors)

    sizes = ["length"] if "length" in wanted.columns else []
    rows = dealt_out(wanted.select(*dict.fromkeys(["path", *sizes, *extra]))).select("path", *extra)
    others = "".join(f", {name} {rows.schema[name].dataType.simpleString()}" for name in extra)
    return rows.mapInArrow(run, f"path string, {column} {kind}, error string{others}")


def read_files(wanted: DataFrame, *extra: str) -> DataFrame:
    """``path, content, error`` of the wanted files, with ``extra`` columns of the listing.

    Tasks open the listed files and no others; contents stay in the task that read them. A file that can't
    be opened, or is gone since it was listed, is a row with null content and the ``error``.
    """
    return _opened(wanted, "binary", bytes, extra)


def read_texts(wanted: DataFrame, *extra: str) -> DataFrame:
    """``path, value, error``: the wanted files as whole texts (:func:`as_text`), so lines keep their order."""
    return _opened(wanted, "string", as_text, extra)
