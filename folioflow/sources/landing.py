"""Landing folders as DataFrames."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.times import moment
from folioflow.operators.skew import broadcast_if_small
from folioflow.session import cut_lineage
from folioflow.sources.contents import read_files, read_texts
from folioflow.sources.names import folders_of, files_below
from folioflow.sources.stores import reachable

# Globs are case-sensitive; file names on the landing share are not.
PDF_FILES = "*.[pP][dD][fF]"
TXT_FILES = "*.[tT][xX][tT]"
XML_FILES = "*.[xX][mM][lL]"

#: Splits of a listing that go to one task.
LISTED_SPLITS = 64

_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
_LISTED_SCHEMA = "path string, modificationTime timestamp_ntz, creation_time timestamp_ntz, length long"


def list_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Files of a folder, subfolders and empty files left out: ``path, modificationTime, creation_time, length``.

    File systems behind Spark report no creation time, so it equals the write time here. Tasks list the folder and
    write the listing down, as of the call: the driver sees none of it, and no later step lists again. Only where tasks
    can't reach the folder Spark's own file source lists it, on the driver.
    """
    if not reachable(folder):
        return _timed(_listed_by_driver(spark, folder, glob))
    return _timed(cut_lineage(files_below(spark, folders_of(spark, folder), glob)))


def _listed_by_driver(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """The content column is not selected and therefore not read. A listed file costs next to nothing, so many
    more of them make a task than Spark would give it for reading.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    splits = files.rdd.getNumPartitions()
    files = files.coalesce(max(1, min(splits, spark.sparkContext.defaultParallelism), splits // LISTED_SPLITS))
    return files.select("path", "modificationTime", "length")


def _timed(files: DataFrame) -> DataFrame:
    written = F.col("modificationTime").cast("timestamp_ntz")
    return files.select("path", written.alias("modificationTime"), written.alias("creation_time"), "length")


def stream_files(
    spark: SparkSession, folder: str, glob: str, max_files: int = 2000, max_age: str = "36500d"
) -> DataFrame:
    """Newly landed files as a stream; each micro-batch takes at most ``max_files``, none of them lost.

    Spark passes over files whose write time lies ``max_age`` before the newest it has seen. The default
    lets through whatever lands, also files that were moved here with their old times; the price is that
    the stream's log remembers every path. A shorter age bounds that and leaves old files to the daily run.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", max_age)
        .load(folder)
    )
    return _timed(files)


def stream_listing(spark: SparkSession, folder: str, glob: str, arrivals: str, max_files: int = 2000) -> DataFrame:
    """What has landed until now as a stream that ends; the columns and micro-batches of :func:`stream_files`.

    Tasks list the folder. Paths that earlier calls have not seen are added to the table ``arrivals``, oldest first in
    files of at most ``max_files`` rows, and the stream takes one of these at a time: its driver and its log know
    the files of that table, not those of the folder.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(arrivals)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(place)
    before = {part.getPath().getName(): part.getModificationTime() for part in files.listStatus(place)}
    seen = spark.read.schema(_LISTED_SCHEMA).parquet(arrivals).select("path")
    fresh = cut_lineage(list_files(spark, folder, glob).join(seen, "path", "left_anti"))
    count = fresh.count()
    if count:
        # Ranges are sampled: a few more than are needed keeps nearly all of them below the limit.
        parts = 1 if count <= max_files else -(-count * 10 // (max_files * 9))
        order = ["modificationTime", "path"]
        rows = fresh.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        rows.write.mode("append").option("maxRecordsPerFile", max_files).parquet(arrivals)
        # The stream goes by write times.
        added = sorted(n for n in (part.getPath().getName() for part in files.listStatus(place)) if n.startswith("part-") and n not in before)
        start = max([int(time.time() * 1000), *(t + 1 for t in before.values())])
        for number, name in enumerate(added):
            files.setTimes(hadoop.Path(place, name), start + number, -1)
    stream = spark.readStream.schema(_LISTED_SCHEMA).option("maxFilesPerTrigger", 1).option("maxFileAge", "36500d")
    return stream.parquet(arrivals)


def read_content(spark: SparkSession, folder: str, glob: str, wanted: DataFrame, *extra: str) -> DataFrame:
    """``path, content`` of the wanted files (a listing, paths unique), with ``extra`` columns of it.

    Tasks open exactly these files. Where only Spark's own file systems know the folder's scheme, the folder
    is scanned instead: the write-time range of the wanted files is pushed into the scan, so files outside
    it are not opened. Files that are gone or can't be opened are left out.
    """
    if reachable(folder):
        return read_files(wanted, *extra).where("content is not null").drop("error")
    return _scanned(spark, folder, glob, wanted, *extra)


def _scanned(spark: SparkSession, folder: str, glob: str, wanted: DataFrame, *extra: str) -> DataFrame:
    bounds = wanted.agg(F.min("modificationTime").alias("a"), F.max("modificationTime").alias("b")).first()
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    if bounds["a"] is not None:
        # A day wider on both ends: local times that occur twice would otherwise cut files off.
        day = dt.timedelta(days=1)
        low, high = (moment(t).cast("timestamp") for t in (bounds["a"] - day, bounds["b"] + day))
        files = files.where((F.col("modificationTime") >= low) & (F.col("modificationTime") <= high))
    return files.select("path", "content").join(broadcast_if_small(wanted.select("path", *extra)), "path")


def read_documents(spark: SparkSession, folder: str, glob: str, wanted: DataFrame, *extra: str) -> DataFrame:
    """``path, value``: the wanted files as whole texts, so lines keep their order, with ``extra`` columns of the listing.

    Byte order marks are heeded. A file that is gone or can't be opened has a null value: no document.
    """
    if reachable(folder):
        return read_texts(wanted, *extra).drop("error")
    content = _scanned(spark, folder, glob, wanted, *extra)
    return content.select("path", F.col("content").cast("string").alias("value"), *extra)
