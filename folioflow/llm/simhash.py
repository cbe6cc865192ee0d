"""SimHash near-duplicates found through covering locality-sensitive hashing.

A fingerprint has 64 bits. For radius r, every bit position gets a random non-zero vector of r + 1
bits; the mask of table v (a non-zero vector of r + 1 bits) holds the positions whose vector has odd
inner product with v. Two fingerprints that differ in at most r positions span at most r dimensions
there, so some v is orthogonal to all of them: in that table the masked fingerprints are equal. With
r = 4 these are 31 tables of about 32 bits each, and no pair within the radius is missed.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from folioflow.llm.common import frugal, staged, whole_row
from folioflow.llm.components import components

BITS = 64
#: A bucket of at most so many different fingerprints is compared inside one row.
PAIRWISE = 2048
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def simhash(text: bytes | None, width: int = 4) -> int:
    """Majority vote of the XXH64 (seed 42) bits of all ``width``-word shingles, repeats included.

    Lower-cases A-Z. Fewer words than ``width``: one shingle of them all; none or null: 0.
    """
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    ones, shingles = np.zeros(BITS, np.int64), len(words) - width + 1
    for start in range(0, shingles, 65536):  # long texts in blocks
        part = words[start : start + 65536 + width - 1]
        hashes = np.array([digest(join(s), 42) for s in zip(*(part[k:] for k in range(width)))], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << int(k) for k in np.flatnonzero(2 * ones > shingles))


def _printed(rows: DataFrame, width: int) -> DataFrame:
    """``key``, ``fp`` (signed long) of rows of a key of any type and a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            values = np.array([simhash(t.as_py(), width) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["key", "fp"])

    key = StructField("key", rows.schema[0].dataType)
    return rows.mapInArrow(frugal(run), StructType([key, StructField("fp", LongType())]))


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """``doc_id``, ``fp`` (signed long) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _printed(rows, width).withColumnRenamed("key", "doc_id")


def covering_masks(radius: int, seed: int = 7) -> list[int]:
    """The bit masks of all tables: any two fingerprints within ``radius`` agree under one of them."""
    draw = random.Random(seed)
    vectors = [draw.randrange(1, 1 << (radius + 1)) for _ in range(BITS)]
    return [
        sum(1 << bit for bit, x in enumerate(vectors) if (x & v).bit_count() % 2) for v in range(1, 1 << (radius + 1))
    ]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(values: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Edges that connect what lies within the radius, at most one for each value."""
    left = values
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = np.bitwise_count((left ^ at).view(np.uint64)) <= radius
            for other in left[near]:
                yield int(at), int(other)
                frontier.append(other)
            left = left[~near]


def _grouped(radius: int, pairwise: int):
    """Edges inside buckets, from rows (bucket, fp) sorted by bucket; read as a stream."""
    schema = ["bucket", "u", "v"]

    def rows(bucket: list[int], u: list[int], v: list[int | None]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (bucket, u, v)], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, full = (np.empty(0, np.int64), np.empty(0, np.int64)), None
        for batch in batches:
            keys = np.concatenate([held[0], batch.column(0).to_numpy()])
            fps = np.concatenate([held[1], batch.column(1).to_numpy()])
            if not len(keys):
                continue
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            ends = np.concatenate([starts[1:], [len(keys)]])
            edges: list[tuple[int, int, int | None]] = []
            for a, b in zip(starts[:-1], ends[:-1]):
                if full == keys[a] or b - a > pairwise:
                    edges += [(int(keys[a]), int(f), None) for f in fps[a:b]]
                elif b - a > 1:
                    edges += [(int(keys[a]), x, y) for x, y in _forest(fps[a:b], radius)]
            last = int(starts[-1])
            held = keys[last:], fps[last:]
            if full == keys[last] or len(keys) - last > pairwise:
                # Too full to be compared here: its members are handed on as they come.
                full = int(keys[last])
                edges += [(full, int(f), None) for f in held[1]]
                held = np.empty(0, np.int64), np.empty(0, np.int64)
            else:
                full = None
            yield rows(*([list(x) for x in zip(*edges)] or [[], [], []]))
        if len(held[0]) > 1:
            edges = [(int(held[0][0]), x, y) for x, y in _forest(held[1], radius)]
            yield rows(*([list(x) for x in zip(*edges)] or [[], [], []]))

    return run


def links(different: DataFrame, radius: int = 4, pairwise: int = PAIRWISE) -> DataFrame:
    """Edges ``u``, ``v`` between fingerprints, enough to connect all that differ in ``radius`` bits or fewer.

    ``different`` holds each fingerprint once. It is shuffled once, to its bucket in each table, and
    the buckets are read as a sorted stream. Of a bucket of up to ``pairwise`` fingerprints only a
    spanning forest comes out. Fuller buckets go the exact way of :func:`_through_midpoints`, which
    makes no pairs at all.
    """
    found = staged(
        different.select("fp", F.explode(F.array(*_buckets(radius))).alias("bucket"))
        .select("bucket", "fp")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_grouped(radius, pairwise), "bucket long, u long, v long"),
        "links",
    )
    members = found.where("v is null").select("bucket", F.col("u").alias("fp"))
    return found.where("v is not null").select("u", "v").unionByName(_through_midpoints(members, radius)).distinct()


def _buckets(radius: int) -> list:
    """The bucket of a fingerprint in each table, as one number. Should two buckets share a number,
    they are only compared in vain."""
    return [
        F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for t, m in enumerate(covering_masks(radius))
    ]


def _through_midpoints(members: DataFrame, radius: int) -> DataFrame:
    """Edges of buckets of any size, in time linear in their members.

    Two fingerprints lie within 4 bits of each other exactly if some value lies within 2 bits of
    both. Every member names all values near it that its bucket allows; those that name the same
    value are linked to the least of them. A value has a bounded number of neighbours, so no group
    is large.
    """
    if radius not in (2, 4):
        raise ValueError("midpoints exist for radius 2 and 4")
    half = radius // 2
    free = F.array(
        *[F.array(*[F.lit(_signed(1 << b)) for b in range(BITS) if not m >> b & 1]) for m in covering_masks(radius)]
    )
    near = F.concat(F.array(F.lit(0).cast("long")), F.col("free"))
    if half == 2:
        near = F.array_distinct(F.flatten(F.transform(near, lambda a: F.transform(near, lambda b: a.bitwiseXOR(b)))))
    tables = F.filter(
        F.transform(F.array(*_buckets(radius)), lambda b, t: F.when(b == F.col("bucket"), t)), lambda t: t.isNotNull()
    )
    named = (
        members.select("fp", F.explode(tables).alias("t"))
        .withColumn("free", F.get(free, F.col("t")))
        .select("fp", F.explode(near).alias("flip"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("z"))
        .distinct()
    )
    least = named.groupBy("z").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1").select("z", "v")
    return named.join(least, "z").where("fp <> v").select(F.col("fp").alias("u"), "v")


def near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` of every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``, other columns are ignored. Null or wordless texts have
    fingerprint zero and are linked like any other. ``component_id`` is the least ``doc_id``
    reachable through links of at most ``radius`` differing bits, itself included; rows with a null
    id take part and get the component of their fingerprint, null if no id is in it. Repeated rows
    give repeated results; an empty table gives an empty one. Texts with the same fingerprint are one
    node, so copies are never paired.
    """
    printed = staged(fingerprints(docs, width), "fingerprints")
    nodes = staged(printed.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(nodes.select("fp"), radius))
    joined = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    joined = staged(joined, "rooted")
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = joined.join(least, "root").select("fp", "component_id")
    return printed.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each_group(docs: DataFrame, radius: int = 4, width: int = 4) -> DataFrame:
    """One row of ``docs`` for each component: that of the least id, of equal ids the least hash of the text.

    Rows are told apart by id and text, so different texts under one id are rows of their own, and each
    goes only if its own component has another row. Rows without an id count after all others. Rows
    that agree in both are one, and the first found of them stays. All columns are returned unchanged;
    an empty table gives an empty one.
    """
    text = F.coalesce(F.xxhash64(F.col("text").cast("string")), F.lit(0))
    key = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").cast("long").alias("id"), text.alias("text"))
    rows = docs.select(whole_row(docs), key.alias("_key"), F.col("text").cast("string").alias("_text"))
    printed = staged(_printed(rows.select("_key", "_text"), width), "fingerprints")
    nodes = staged(printed.groupBy("fp").agg(F.min("key").alias("first")), "nodes")
    roots = components(links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    stay = nodes.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp")).agg(F.min("first").alias("_key")).select("_key")
    # Fields of the key are never null together with a difference: a join needs them without nulls.
    parts = [F.col("_key.nameless").alias("_k0"), F.coalesce("_key.id", F.lit(0)).alias("_k1"), F.col("_key.text").alias("_k2")]
    names = ["_k0", "_k1", "_k2"]
    return rows.select("_row", *parts).join(stay.select(*parts), names).dropDuplicates(names).select("_row.*")
