"""Append-only tables that become visible one batch at a time.

A batch writes its rows to directories of its own and then one row to the commit log. Readers
take only what the log names, so a job that died half way leaves nothing behind that anyone sees,
running a batch again overwrites its own directories, and a committed batch is not run twice.

Several writers may commit. A commit first claims the next number by creating a file that must not exist yet, so
numbers are unique; it also tells up to which number its writer had seen the ledger. Where others committed in
between, both may hold a key that should be there once. Such batches are contested: readers leave out their
rows whose key one of the batches in between holds (:meth:`uncontested`). Without them nothing is compared.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "kind string, sequence long, committed_at timestamp_ntz, seen long, batch_id string"


def partition_name(batch_id: str) -> str:
    # The prefix keeps Spark from reading a numeric batch id back as a number.
    return f"b_{batch_id}"


def claimed(spark: SparkSession, path: str) -> bool:
    """Create a file, unless it is there; the file system lets only one caller do so."""
    context = spark.sparkContext
    file = context._jvm.org.apache.hadoop.fs.Path(path)
    try:
        return file.getFileSystem(context._jsc.hadoopConfiguration()).createNewFile(file)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise


class Ledger:
    #: Called before each commit; raises where the batch must not be shown.
    guard: Callable[[], object] | None = None

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, str]):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = tables
        for name, schema in {**tables, "log": _LOG.rsplit(", ", 1)[0]}.items():
            empty = spark.createDataFrame([], schema)
            empty.coalesce(1).write.mode("ignore").parquet(self._directory(name, "none"))

    def _directory(self, table: str, batch_id: str) -> str:
        return f"{self.root}/{table}/batch_id={partition_name(batch_id)}"

    def log(self) -> DataFrame:
        return self.spark.read.schema(_LOG).parquet(f"{self.root}/log")

    def committed(self, batch_id: str) -> bool:
        return not self.log().where(F.col("batch_id") == partition_name(batch_id)).isEmpty()

    def last_sequence(self) -> int:
        """Number of the last commit; a writer asks before it looks at the tables."""
        return self.log().agg(F.max("sequence").alias("s")).first()["s"] or 0

    def _live(self) -> DataFrame:
        """Commits that make up the tables: the last snapshot and every batch after it."""
        log = self.log()
        since = log.where(F.col("kind") == "snapshot").agg(F.max("sequence").alias("s")).first()["s"]
        return log.where(F.col("sequence") >= (since or 0))

    def _rows(self, table: str, live: DataFrame) -> DataFrame:
        schema = f"{self.tables[table]}, batch_id string"
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        # One log row per batch: pruning by it skips the directories of other batches.
        return rows.join(live.select("batch_id"), "batch_id", "left_semi")

    def stored(self, table: str) -> DataFrame:
        """Rows of the last snapshot and of every batch committed after it."""
        return self._rows(table, self._live()).drop("batch_id")

    def uncontested(self, table: str, key: Column, names: str) -> DataFrame:
        """Rows of a table, with their ``batch_id``, without those that lost their key to an earlier commit.

        ``names`` is the table that holds the key of every row as ``key``, ``key`` how the table spells it. Only
        contested batches are compared with what was committed meanwhile; their number is that of writers
        that overlapped since the last snapshot.
        """
        live = self._live().select("batch_id", "sequence", F.coalesce("seen", F.col("sequence") - 1).alias("seen"))
        rows = self._rows(table, live)
        contested = live.where("seen < sequence - 1")
        if contested.isEmpty():
            return rows
        held = self._rows(names, live).join(F.broadcast(live.select("batch_id", "sequence")), "batch_id")
        mine = self._rows(names, contested).join(F.broadcast(contested), "batch_id")
        between = (F.col("m.key") == F.col("h.key")) & (F.col("h.sequence") > F.col("m.seen")) & (F.col("h.sequence") < F.col("m.sequence"))
        lost = mine.alias("m").join(held.select("key", "sequence").alias("h"), between, "left_semi")
        lost = lost.select("batch_id", F.col("key").alias("_key")).distinct()
        return rows.withColumn("_key", key).join(lost, ["batch_id", "_key"], "left_anti").drop("_key")

    def write(self, table: str, batch_id: str, rows: DataFrame) -> None:
        columns = [part.split()[0] for part in self.tables[table].split(", ")]
        rows.select(*columns).write.mode("overwrite").parquet(self._directory(table, batch_id))

    def written(self, table: str, batch_id: str) -> DataFrame:
        """What :meth:`write` wrote, committed or not."""
        return self.spark.read.schema(self.tables[table]).parquet(self._directory(table, batch_id))

    def commit(self, batch_id: str, as_of: dt.datetime, kind: str = "batch", seen: int | None = None) -> None:
        """Show a batch. ``seen`` is the last number its writer knew when it checked for keys; the last, if not given."""
        if self.guard is not None:
            self.guard()
        last = self.last_sequence()
        seen = last if seen is None else seen
        sequence = last + 1
        while not self._claimed(sequence):
            sequence += 1
        row = self.spark.createDataFrame([(kind, sequence, as_of, seen)], _LOG.rsplit(", ", 1)[0])
        row.coalesce(1).write.mode("overwrite").parquet(self._directory("log", batch_id))

    def _claimed(self, sequence: int) -> bool:
        return claimed(self.spark, f"{self.root}/claims/{sequence:012d}")
