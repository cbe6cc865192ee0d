"""Scans of registered-document tables kept elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def from_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def from_jdbc(
    spark: SparkSession, url: str, table: str, predicates: list[str] | None = None, **properties: str
) -> DataFrame:
    """A relational table; ``predicates`` (one per partition) let executors read it side by side."""
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)
