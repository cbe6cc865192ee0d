"""What has changed in a folder since it was last looked at, kept as a table of change sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.sinks.ledger import Ledger

NEW, CHANGED, GONE = "new", "changed", "gone"

_FILES = "path string, modificationTime timestamp_ntz, length long, change string"


def listing_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """Files that are new, changed or gone: ``path, modificationTime, length, change``.

    Both listings hold each path once; rows without a path are left out. A file has changed when its write time or
    length differs; one that is gone has those it had. One shuffle on the unique path.
    """
    kept = ("modificationTime", "length")
    old = before.where("path is not null").select("path", F.struct(*kept).alias("_old"))
    new = now.where("path is not null").select("path", F.struct(*kept).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), NEW)
        .when(F.col("_new").isNull(), GONE)
        .when(~F.col("_old").eqNullSafe(F.col("_new")), CHANGED)
    )
    both = new.join(old, "path", "full").withColumn("change", change).where("change is not null")
    return both.select("path", F.coalesce("_new", "_old").alias("_file"), "change").select("path", "_file.*", "change")


class ListingLog(Ledger):
    """The listing of one folder as the sum of its change sets, for one writer.

    A run takes what has changed, works on it and then commits: what a run that died had taken is taken again.
    A run writes its change set only, however many files the folder holds; :meth:`compact` folds the sets in
    when they have become many.
    """

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root, {"files": _FILES})

    def listing(self) -> DataFrame:
        """Files as of the last committed run."""
        live = self._live().select("batch_id", "sequence")
        rows = self._rows("files", live).join(live, "batch_id")
        latest = F.max_by(F.struct("modificationTime", "length", "change"), "sequence").alias("_last")
        return rows.groupBy("path").agg(latest).select("path", "_last.*").where(F.col("change") != GONE).drop("change")

    def take(self, batch_id: str, listed: DataFrame) -> DataFrame:
        """Change set of a run. A run that is repeated gets the set its first attempt wrote."""
        if not self._written(batch_id):
            self.write("files", batch_id, listing_changes(self.listing(), listed))
        return self.spark.read.schema(_FILES).parquet(self._directory("files", batch_id))

    def compact(self, name: str, as_of: dt.datetime) -> None:
        """Write the whole listing once; later reads go on from it."""
        self.write("files", name, self.listing().withColumn("change", F.lit(NEW)))
        self.commit(name, as_of, kind="snapshot")

    def _written(self, batch_id: str) -> bool:
        context = self.spark.sparkContext
        mark = context._jvm.org.apache.hadoop.fs.Path(f"{self._directory('files', batch_id)}/_SUCCESS")
        return mark.getFileSystem(context._jsc.hadoopConfiguration()).exists(mark)
