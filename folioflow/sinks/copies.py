"""Files written by tasks: copies of listed files and files made from rows."""

from __future__ import annotations

import contextlib
import hashlib
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.session import cut_lineage
from folioflow.sources.contents import dealt_out
from folioflow.sources.stores import FAILURES, Stores

_CHUNK = 4 << 20
_OUTCOME = "path string, target string, bytes long, sha256 string, error string"


def _each(rows: DataFrame, put: Callable[[Stores, tuple, str], tuple[int, str]]) -> DataFrame:
    """One outcome per row (``path, target, ...``), written down so that no later step copies again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores, attempt = Stores(), uuid.uuid4().hex
        with contextlib.closing(stores):
            for batch in batches:
                done: list[tuple[int | None, str | None, str | None]] = []
                for row in zip(*(column.to_pylist() for column in batch.columns)):
                    try:
                        done.append((*put(stores, row, attempt), None))
                    except FAILURES as failure:
                        done.append((None, None, f"{type(failure).__name__}: {failure}"))
                kinds = (pa.int64(), pa.string(), pa.string())
                columns = [pa.array([d[k] for d in done], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["path", "target", "bytes", "sha256", "error"])

    return cut_lineage(rows.mapInArrow(run, _OUTCOME))


def copy_files(rows: DataFrame) -> DataFrame:
    """Copy every ``path`` to its ``target``; returns ``path, target, bytes, sha256, error``.

    Bytes go from the source to the target in chunks and never through Spark. A copy gets its name when it
    is complete, so a task that is run again or twice at once leaves one whole file. A copy that fails is a
    row with its ``error``, and the others go on. ``length``, if there is one, helps to share out the work;
    of rows with equal targets the last to finish stays.
    """

    def put(stores: Stores, row: tuple, attempt: str) -> tuple[int, str]:
        digest, size = hashlib.sha256(), 0

        def write(out: pa.NativeFile) -> None:
            nonlocal size
            with stores.open(row[0]) as source:
                while chunk := source.read(_CHUNK):
                    out.write(chunk)
                    digest.update(chunk)
                    size += len(chunk)

        stores.put(row[1], write, attempt)
        return size, digest.hexdigest()

    return _each(dealt_out(rows).select("path", "target"), put)


def write_files(rows: DataFrame) -> DataFrame:
    """Make a file ``target`` of every row's ``content``; null is empty. Outcomes as for :func:`copy_files`.

    ``modified``, if there is such a column, is the write time to give it in seconds since 1970, where the
    file system is a mounted one that lets it be set.
    """
    modified = F.col("modified").cast("double") if "modified" in rows.columns else F.lit(None).cast("double")

    def put(stores: Stores, row: tuple, attempt: str) -> tuple[int, str]:
        _, target, content, when = row
        content = content or b""
        stores.put(target, lambda out: out.write(content), attempt)
        files, inner = stores.find(target)
        if when is not None and isinstance(files, arrow_fs.LocalFileSystem):
            os.utime(inner, (when, when))
        return len(content), hashlib.sha256(content).hexdigest()

    wanted = rows.select(F.lit(None).cast("string").alias("path"), "target", F.col("content").cast("binary").alias("content"), modified.alias("modified"))
    return _each(wanted, put).drop("path")
