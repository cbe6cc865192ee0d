"""What the operators share: the word rule, staging in the shared folder, identity of rows."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.session import scratch_path

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"

Batches = Iterator[pa.RecordBatch]
#: Rows that Python code looks at and hands on at a time.
ROWS_AT_ONCE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column | str) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, as an array; null has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def word_count(text: Column | str) -> Column:
    return F.size(words_of(text)).cast("long")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once to the folder all executors share and go on from there.

    Lost executors then cost a re-read, not a recomputation, and a frame that is read twice is
    computed once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_key(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``_a``, ``_b``: 96 bits that tell rows apart by their contents.

    Rows that agree in ``columns`` are interchangeable for the operators, so they may share a key;
    null and repeated ids then need no special case in joins.
    """
    return df.withColumn("_a", F.xxhash64(*columns)).withColumn("_b", F.hash(*columns))


def whole_row(df: DataFrame) -> Column:
    """All columns as one, ``_row``, so that columns added beside it can't clash with them."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias("_row")


def random_unit(seed: int, *columns: str) -> Column:
    """A number in (0, 1) that depends on nothing but ``seed`` and the row: 48 bits of an MD5.

    The same bits in SQL: ``('0x' || substr(md5(...), 1, 12))::bigint``.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    bits = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 48))


def frugal(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, fed with small batches; memory goes back to the system at the end.

    Spark's batches hold ten thousand rows, which may be long texts, and its Python workers live on
    after a task with all the memory that they ever had.
    """

    def sliced(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                yield batch.slice(at, ROWS_AT_ONCE)

    def all_of(batches: Batches) -> Batches:
        try:
            yield from run(sliced(batches))
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return all_of
