"""Listings made by tasks."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.sources.stores import Stores

#: Names that a task hands on at a time.
BATCH_NAMES = 4096

_NAMED = "path string, name string, length long, millis long"


def folders_of(spark: SparkSession, folder: str) -> list[str]:
    """The folders a path or a glob names, as Spark spells them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [hit.getPath().toString() for hit in files.globStatus(path) or [] if hit.isDirectory()]
    if not found:
        raise FileNotFoundError(f"no such folder: {folder}")
    return found


def files_below(spark: SparkSession, folders: list[str], glob: str) -> DataFrame:
    """``path, modificationTime, length`` of the files right in the folders whose name the glob matches.

    Empty files, and hidden ones by the rules of Spark's readers, are left out. A task streams the names of a
    folder; they are dealt out before they are looked up one by one, so a share that answers slowly is asked
    by all cores. Stores that tell sizes and times with the names are asked once.
    """
    cores = spark.sparkContext.defaultParallelism
    roots = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(min(cores, len(folders)), "folder")
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    hidden = F.col("name").rlike(r"^(?:\.|_[^=]*\z)|\._COPYING_\z")
    wanted = roots.mapInArrow(_names, _NAMED).where(F.col("name").rlike(f"(?s)^(?:{pattern})\\z") & ~hidden)
    seen = wanted.repartition(cores, "path").mapInArrow(_looked_up, _NAMED)
    return seen.where("length > 0").select("path", F.timestamp_millis("millis").alias("modificationTime"), "length")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)], ["path", "name", "length", "millis"]
    )


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies in each folder; sizes and times too, if the store gives them along."""
    stores = Stores()
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            rows: list[tuple] = []
            for name, length, millis in _entries(stores, folder):
                rows.append((f"{folder.rstrip('/')}/{name}", name, length, millis))
                if len(rows) >= BATCH_NAMES:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)


def _entries(stores: Stores, folder: str) -> Iterator[tuple[str, int | None, int | None]]:
    files, inner = stores.find(folder)
    if isinstance(files, arrow_fs.LocalFileSystem):
        with os.scandir(inner) as entries:
            for entry in entries:
                # Names that are no text are spelled as Spark spells them.
                yield os.fsencode(entry.name).decode("utf-8", "replace"), None, None
        return
    for info in files.get_file_info(arrow_fs.FileSelector(inner)):
        if info.type == arrow_fs.FileType.File:
            yield info.base_name, info.size, (info.mtime_ns or 0) // 1_000_000


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes and times of names that came without; what is gone meanwhile, or no file, is left out."""
    stores = Stores()
    for batch in batches:
        rows = []
        for path, name, length, millis in zip(*(column.to_pylist() for column in batch.columns)):
            if length is None:
                found = stores.about(path)
                if found is None:
                    continue
                length, millis = found
            rows.append((path, name, length, millis))
        yield _batch(rows)
