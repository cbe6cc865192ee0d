"""Session settings the jobs rely on, and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: Tables that :func:`settle` is to delete, while it has rows made.
_passing: ContextVar[list[str] | None] = ContextVar("_passing", default=None)


def local_session(cores: str = "*", app: str = "folioflow", **conf: str) -> SparkSession:
    """A session for tests and benchmarks. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read: what ``spark.checkpoint.dir`` names.

    Only a local master may fall back on a temporary folder; elsewhere a machine-local
    folder would be lost with its executor.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if current is not None:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="folioflow-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and go on from there.

    As a table: it is compressed, later steps read the columns they need, and a task reads a split of it, however
    few tasks wrote it.
    """
    path = scratch_path(df.sparkSession, "rows")
    passing = _passing.get()
    if passing is not None:
        passing.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(make: Callable[[], DataFrame]) -> DataFrame:
    """:func:`cut_lineage` of what ``make`` returns, without the tables that were written on the way.

    They are deleted once the rows are written, so nothing else that ``make`` made may be read afterwards.
    """
    token = _passing.set(passing := [])
    try:
        rows = make()
    finally:
        _passing.reset(token)
    kept = cut_lineage(rows)
    context = kept.sparkSession.sparkContext
    for path in passing:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
    return kept
