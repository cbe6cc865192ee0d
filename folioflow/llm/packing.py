"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing."""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm.common import frugal, staged

CAPACITY = 4096
#: Written after every document.
END_ID = 1
#: Items that one task packs at a time.
GROUP = 50_000
#: Bytes of text that are encoded at a time.
TEXT_AT_ONCE = 2 << 20
#: Parts of texts a worker remembers before it begins anew.
_REMEMBERED = 500_000
#: Signs at the end of a part, after a plain letter or digit: they are encoded by themselves. Not those
#: that contractions and marks are made of.
_CLOSING = r"""([a-z0-9])([.,;:!?*$%&#@+/~^_"()\[\]{}-]+)([\x20\x09-\x0D]|$)"""


class _Encoder:
    """Ids of many texts at a time.

    The vocabulary drops white space and case, so the ids of a text are those of its parts between
    ASCII white space one after another. Arrow splits the texts and numbers their different parts; ids
    of parts seen before lie in one array, from which all parts of all texts are gathered at once. New
    parts are encoded many at a time, with a sign between them that stands for itself.
    """

    SIGN = "|"

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.sign,) = self._ids(self.SIGN)
        # Numbers of the parts met so far, the empty one first; where their ids begin and how many they are.
        self.numbers = {"": 0}
        self.starts, self.counts = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)
        #: In how many calls a part was met.
        self.met = np.zeros(1, np.int32)

    def _keep_common(self) -> None:
        """Forget the parts that were met once only since the last time; all, if too few are."""
        common = np.flatnonzero(self.met > 1)
        if len(common) > _REMEMBERED // 2:
            common = common[:0]
        common = np.concatenate([[0], common[common > 0]])
        parts = list(self.numbers)
        ends, ids = self._lists(common)
        self.numbers = {parts[k]: n for n, k in enumerate(common.tolist())}
        self.starts, self.counts, self.ids = ends[:-1], np.diff(ends), ids
        self.met = np.zeros(len(common), np.int32)

    def _ids(self, text: str) -> np.ndarray:
        (coded,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(coded.ids, dtype="<u4")

    def __call__(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, ``END_ID`` after each; where each text's ids begin, and the end."""
        lower = pc.replace_substring_regex(pc.ascii_lower(texts.fill_null("")), _CLOSING, r"\1 \2\3")
        split = pc.ascii_split_whitespace(lower)
        coded = split.flatten().dictionary_encode()
        if len(self.numbers) > _REMEMBERED:
            self._keep_common()
        parts = coded.dictionary.to_pylist()
        self._learn([p for p in parts if p not in self.numbers])
        number = np.fromiter(map(self.numbers.__getitem__, parts), np.int64, len(parts))
        self.met = np.concatenate([self.met, np.zeros(len(self.numbers) - len(self.met), np.int32)])
        self.met[number] += 1
        # The ids of this call's parts, each part a list, taken as often as it stands in the texts.
        ends, known = self._lists(number)
        own = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(known)).take(coded.indices)
        bounds = own.offsets.to_numpy()[split.offsets.to_numpy() - split.offsets[0].as_py()].astype(np.int64)
        ids = np.full(bounds[-1] + len(texts), END_ID, np.uint32)
        inside = np.ones(len(ids), bool)
        inside[bounds[1:] + np.arange(len(texts))] = False
        ids[inside] = own.values.to_numpy()
        return ids, bounds + np.arange(len(bounds))

    def _lists(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these parts in a row; where each part's begin, and the end."""
        counts = self.counts[number]
        ends = np.concatenate([[0], np.cumsum(counts)])
        # The part's first id, less where it goes: added to every place this is where the id is found.
        ids = self.ids[np.repeat(self.starts[number] - ends[:-1], counts) + np.arange(ends[-1])]
        return ends, ids

    def _add(self, parts: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids])
        self.numbers.update(zip(parts, range(len(self.numbers), len(self.numbers) + len(parts)), strict=True))

    def _learn(self, new: list[str]) -> None:
        """Make parts known that are not."""
        plain = [p for p in new if self.SIGN not in p]
        for at in range(0, len(plain), 2000):
            some = plain[at : at + 2000]
            ids = self._ids(f" {self.SIGN} ".join(some))
            ends = np.flatnonzero(ids == self.sign)
            self._add(some, ids[ids != self.sign], np.diff(ends, prepend=-1, append=len(ids)) - 1)
        for part in new:
            if self.SIGN in part:
                ids = self._ids(part)
                self._add([part], ids, np.array([len(ids)]))


def _by_size(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``TEXT_AT_ONCE`` bytes of text; a longer text comes alone."""
    sizes = pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > at and held + size > TEXT_AT_ONCE:
            yield batch.slice(at, k - at)
            at, held = k, 0
        held += size
    if batch.num_rows:
        yield batch.slice(at)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, unless left out, ``ids``
    (little-endian unsigned 32-bit) of all rows.

    The ids of the text, then ``END_ID``; a null text is empty. Only documents longer than
    ``capacity`` are cut. Other columns of ``docs`` are ignored, null ids and repeated rows are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _Encoder(tokenizer)
        for batch in batches:
            for some in _by_size(batch):
                ids, bounds = encode(some.column(1))
                yield cut(some.column(0), ids.astype("<u4", copy=False), bounds)

    def cut(doc_ids: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        lengths = np.diff(bounds)
        count = -(-lengths // capacity)
        row = np.repeat(np.arange(len(lengths)), count)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        length = np.minimum(capacity, lengths[row] - piece * capacity)
        first = bounds[row] + piece * capacity
        views = [ids[a : a + n].data for a, n in zip(first.tolist(), length.tolist())]
        columns = [doc_ids.take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(piece * capacity), pa.array(length)]
        columns.append(pa.array(map(zlib.crc32, views), pa.int64()))
        if with_ids:
            columns.append(pa.array([v.tobytes() for v in views], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(frugal(run), schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin and the offset of each item, and how full each bin is.

    The bits of one integer tell which amounts of free room some bin has, so the fullest bin that
    takes an item is found without a search through the bins.
    """
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    there, filled = 0, []
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = there >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = rooms[room].pop()
            if not rooms[room]:
                there ^= 1 << room
        else:
            room, at = capacity, len(filled)
            filled.append(0)
        bins[item], offsets[item] = at, filled[at]
        filled[at] += length
        if room > length:
            rooms[room - length].append(at)
            there |= 1 << (room - length)
    return bins, offsets, np.array(filled, dtype=np.int64)


def _round(items: DataFrame, tasks: int, level: int, capacity: int) -> DataFrame:
    """Best-fit the items of each of ``tasks`` partitions: adds ``bin``, ``shift`` and the bin's ``total``."""
    schema = T.StructType(items.schema.fields + T._parse_datatype_string("bin long, shift long, total long").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        own = pa.Table.from_batches(rows).combine_chunks()
        bins, offsets, filled = best_fit(own.column("length").to_numpy(), capacity)
        first = (level << 56) | (TaskContext.get().partitionId() << 24)
        for name, values in (("bin", first + bins), ("shift", offsets), ("total", filled[bins])):
            own = own.append_column(name, pa.array(values))
        yield from own.to_batches(max_chunksize=10_000)

    return staged(items.repartition(tasks).mapInArrow(run, schema), f"packed-{level}")


def _underfull(step: DataFrame, capacity: int) -> DataFrame | None:
    """The bins of a round that the next one packs as items: ``item``, ``length``; None if there are none to merge.

    Best fit leaves a task at most one bin that is not over half full, and bins over half full can't
    share a sequence; so every merge needs one of the k bins that are not, a few of ``GROUP`` items.
    They all go on, with the k emptiest of the others. However the k could be put into bins, each bin
    they use can be exchanged for one of the k emptiest, which has as much room; and those left
    over after a round are in the same way enough for the next. So the other bins are full as far as
    any merge goes, and no sequence is lost by leaving them.
    """
    # A bin is met once: by the item that begins it.
    bins = step.where("shift = 0").select(F.col("bin").alias("item"), F.col("total").alias("length"))
    small = F.col("length") * 2 <= capacity
    count, least = bins.where(small).agg(F.count("*"), F.min("length")).first()
    if count == 0:
        return None
    others = bins.where(~small & (F.col("length") <= capacity - least)).orderBy("length", "item").limit(count)
    return bins.where(small).unionByName(others)


def packed(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """The rows of ``items`` with ``sequence_id`` and ``offset``.

    ``items`` has a ``length`` of 1 to ``capacity``; any other columns are kept. Tasks of about
    ``group`` items pack best-fit decreasing by themselves; underfull bins go on as items of their own
    (see :func:`_underfull`: at most two a task, so a round has a small part of the tasks of
    the one before) and are packed again until one task is left. No item is ever dropped. An empty table
    gives an empty one.
    """
    tasks = max(1, math.ceil(items.count() / group))
    level = 0
    done = _round(items, tasks, level, capacity)
    step, moved = done, None
    # A single round is enough for a single task: its bins can't be packed any better.
    while tasks > 1:
        waiting = _underfull(step, capacity)
        if waiting is None:
            break
        level += 1
        waiting = staged(waiting, f"underfull-{level}")
        tasks = min(tasks - 1, math.ceil(waiting.count() / group))
        step = _round(waiting, tasks, level, capacity)
        here = step.select("item", "bin", "shift")
        if moved is None:
            moved = here
        else:
            on = here.select(F.col("item").alias("bin"), F.col("bin").alias("to"), F.col("shift").alias("by"))
            moved = moved.join(on, "bin", "left").select(
                "item", F.coalesce("to", "bin").alias("bin"), (F.col("shift") + F.coalesce("by", F.lit(0))).alias("shift")
            )
    if moved is None:
        return done.withColumnsRenamed({"bin": "sequence_id", "shift": "offset"}).drop("total")
    moved = moved.select(F.col("item").alias("bin"), F.col("bin").alias("_to"), F.col("shift").alias("_by"))
    return (
        done.join(moved, "bin", "left")
        .withColumn("sequence_id", F.coalesce("_to", "bin"))
        .withColumn("offset", F.col("shift") + F.coalesce("_by", F.lit(0)))
        .select(*items.columns, "sequence_id", "offset")
    )


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """All pieces of all rows with their place: ``doc_id``, ``piece``, ``start``, ``length``,
    ``ids_crc32``, ``sequence_id``, ``offset``. See :func:`pieces` for nulls and repeated rows."""
    return packed(staged(pieces(docs, tokenizer, capacity, with_ids=False), "pieces"), capacity, group)


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """The training sequences themselves: ``sequence_id``, ``ids``, and the lengths of its pieces.

    Pieces are placed by their lengths alone; the ids are joined to the places afterwards.
    """
    cut = staged(pieces(docs, tokenizer, capacity).withColumn("key", F.monotonically_increasing_id()), "pieces")
    placed = packed(cut.select("key", "length"), capacity, group).join(cut.select("key", "ids"), "key")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return placed.groupBy("sequence_id").agg(ordered.alias("x")).select(
        "sequence_id",
        F.aggregate("x", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.transform("x", lambda p: p["length"]).alias("lengths"),
    )
