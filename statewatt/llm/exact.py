"""Exact de-duplication by Grace hashing.

Texts are equal when they are identical after lower-casing A-Z. A task first
merges the equal texts it holds itself, so a group of any number of copies
leaves one row per input partition. Those rows are dealt by hash; the receiving
task partitions them into spill files, again and again with further hash bits,
until a bucket fits an open-addressing table, which compares complete contents.
Spill files are scratch of one task and gone when it ends; a task that is lost
is simply run again.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewatt.llm.common import cut, lower_ascii, pick

#: Bytes of text that a task holds at once, and buckets that one pass of spilling makes.
MEMORY_BYTES = 64 << 20
FANOUT = 16

ID, TEXT, HASH, COUNT = "_id", "_text", "_hash", "_count"


class OpenTable:
    """Linear probing over hash values; a hit is a hit only if the contents agree."""

    def __init__(self) -> None:
        self.slots = np.full(1024, -1, np.int64)
        self.hashes: list[int] = []
        self.keys: list[bytes] = []

    def _place(self, h: int) -> None:
        mask = len(self.slots) - 1
        at = (h ^ (h >> 32)) & mask
        while self.slots[at] >= 0:
            at = (at + 1) & mask
        self.slots[at] = len(self.hashes)
        self.hashes.append(h)

    def put(self, h: int, key: bytes) -> tuple[int, bool]:
        """The entry of ``key`` and whether it is new."""
        slots, mask = self.slots, len(self.slots) - 1
        at = (h ^ (h >> 32)) & mask
        while (entry := int(slots[at])) >= 0:
            if self.hashes[entry] == h and self.keys[entry] == key:
                return entry, False
            at = (at + 1) & mask
        if 2 * len(self.keys) >= len(slots):
            old, self.hashes = self.hashes, []
            self.slots = np.full(2 * len(slots), -1, np.int64)
            for each in old:
                self._place(each)
        self._place(h)
        self.keys.append(key)
        return len(self.keys) - 1, True


def _better(a, b) -> bool:
    """Whether id ``a`` beats ``b``: the larger one, and any over none."""
    return a is not None and (b is None or a > b)


class _Groups:
    """Groups of equal texts: for each its best row and the number of its rows."""

    def __init__(self) -> None:
        self.table, self.batches, self.bytes = OpenTable(), [], 0
        self.best: list[tuple] = []  # id, batch, row
        self.counts: list[int] = []

    def add(self, batch: pa.RecordBatch) -> None:
        ids = batch.column(ID).to_pylist()
        texts = batch.column(TEXT).cast(pa.binary()).to_pylist()
        hashes = batch.column(HASH).to_pylist()
        counts = batch.column(COUNT).to_pylist()
        held = 0
        for row, (i, text, h, n) in enumerate(zip(ids, texts, hashes, counts)):
            text = (text or b"").lower()
            entry, new = self.table.put(h & 0xFFFFFFFFFFFFFFFF, text)
            if new:
                self.best.append((i, len(self.batches), row))
                self.counts.append(n)
                held += 2 * len(text) + 100
            else:
                self.counts[entry] += n
                if _better(i, self.best[entry][0]):
                    self.best[entry] = (i, len(self.batches), row)
                    held += len(text)
        self.batches.append(batch)
        self.bytes += held
        self._shrink()

    def _shrink(self) -> None:
        """Lets go of rows that no group needs any more."""
        if len(self.batches) > 8:
            rows = self._rows(keep_order=True)
            self.batches = [rows]
            self.best = [(i, 0, at) for at, (i, _, _) in enumerate(self.best)]

    def _rows(self, keep_order: bool) -> pa.RecordBatch:
        sizes = np.cumsum([0] + [b.num_rows for b in self.batches])
        take = pa.array([int(sizes[b]) + r for _, b, r in self.best], pa.int64())
        whole = pa.Table.from_batches(self.batches).take(take).combine_chunks()
        return whole.to_batches()[0] if whole.num_rows else self.batches[0].slice(0, 0)

    def result(self) -> pa.RecordBatch | None:
        """One row per group, its best one, with the group's number of rows."""
        if not self.best:
            return None
        rows = self._rows(keep_order=True)
        at = rows.schema.get_field_index(COUNT)
        return rows.set_column(at, rows.schema.field(at), pa.array(self.counts, pa.int64()))


def merge_local(batches: Iterable[pa.RecordBatch], memory: int = MEMORY_BYTES) -> Iterator[pa.RecordBatch]:
    """Equal texts of one task merged as far as memory goes; what it can't hold
    it passes on, and a later merge of the same text brings it together."""
    groups = _Groups()
    for batch in batches:
        groups.add(batch)
        if groups.bytes > memory:
            yield groups.result()
            groups = _Groups()
    if (left := groups.result()) is not None:
        yield left


def _bucket(hashes: np.ndarray, depth: int) -> np.ndarray:
    """Another four bits of the mixed hash at each depth."""
    mixed = hashes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(60 - 4 * depth)) & np.uint64(FANOUT - 1)).astype(np.int64)


def grace(batches: Iterable[pa.RecordBatch], memory: int = MEMORY_BYTES, depth: int = 0) -> Iterator[pa.RecordBatch]:
    """One row per distinct text: held in a table if they fit, else partitioned."""
    groups, source = _Groups(), iter(batches)
    for batch in source:
        groups.add(batch)
        if groups.bytes > memory and depth < 15 and len(set(groups.table.hashes)) > 1:
            break
    else:
        if (rows := groups.result()) is not None:
            yield rows
        return
    with tempfile.TemporaryDirectory() as folder:
        first = groups.result()
        del groups
        writers: dict[int, pa.RecordBatchStreamWriter] = {}

        def spill(batch: pa.RecordBatch) -> None:
            bucket = _bucket(np.asarray(batch.column(HASH)), depth)
            for b in np.unique(bucket).tolist():
                if b not in writers:
                    writers[b] = pa.ipc.new_stream(os.path.join(folder, str(b)), batch.schema)
                writers[b].write_batch(batch.take(pa.array(np.flatnonzero(bucket == b))))

        spill(first)
        del first
        for batch in source:
            spill(batch)
        for w in writers.values():
            w.close()
        for b in sorted(writers):
            path = os.path.join(folder, str(b))
            with pa.OSFile(path) as file, pa.ipc.open_stream(file) as stream:
                yield from grace(stream, memory, depth + 1)
            os.remove(path)


def _rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All columns by position, then the four that the merge works on."""
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    i, t = (docs.columns.index(c) for c in (id_col, text_col))
    text = F.coalesce(F.col(f"c{t}"), F.lit(""))
    return flat.withColumns({ID: F.col(f"c{i}"), TEXT: text, HASH: F.xxhash64(lower_ascii(text)), COUNT: F.lit(1).cast("long")})


def _merged(rows: DataFrame, memory: int) -> DataFrame:
    local = rows.mapInArrow(lambda it: merge_local(it, memory), rows.schema)
    return local.repartition(HASH).mapInArrow(lambda it: grace(it, memory), rows.schema)


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", memory: int = MEMORY_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns and unchanged texts.

    Of equal texts the row with the largest id stays; a null id loses to any
    other, and of rows that also share the id exactly one stays. A null text
    counts as empty, and empty texts are equal to each other.
    """
    kept = _merged(_rows_of(docs, id_col, text_col), memory)
    return kept.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(TEXT).cast(pa.binary()).to_pylist()
        sha = [hashlib.sha256(t.lower()).hexdigest() for t in texts]
        yield pa.RecordBatch.from_arrays([pa.array(sha, pa.string()), batch.column(ID), batch.column(COUNT)], ["sha", "keep_id", "group_size"])


def membership(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", memory: int = MEMORY_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept and
    text_sha256 of the normalised text.

    Groups come from the Grace merge, whose table compares complete contents.
    Rows are counted per (digest, id) before they meet their group, so neither
    a text nor an id that a third of the rows share gathers in one task. Two
    groups with one digest would double rows; ``assert_true`` then ends the
    query instead of merging them. Ties and nulls: see ``survivors``.
    """
    few = pick(docs, id_col, text_col).toDF("doc_id", "text")
    kind = few.schema["doc_id"].dataType
    rows = _rows_of(few, "doc_id", "text").select(ID, TEXT, HASH, COUNT)
    schema = T.StructType([T.StructField("sha", T.StringType()), T.StructField("keep_id", kind), T.StructField("group_size", T.LongType())])
    groups = _merged(rows, memory).mapInArrow(_digests, schema)
    once = groups.groupBy("sha").agg(F.count("*").alias("_texts"), F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"))
    once = once.where(F.assert_true(F.col("_texts") == 1, F.lit("two different texts share a SHA-256")).isNull())
    sha = F.sha2(lower_ascii(F.coalesce("text", F.lit(""))).cast("binary"), 256)
    ids = few.select("doc_id", sha.alias("sha")).groupBy("sha", "doc_id").agg(F.count("*").alias("_copies"))
    joined = ids.join(cut(once), "sha")  # both sides are plain shuffles, so a hot digest can be split
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy")
    return joined.select("doc_id", "keep_id", "group_size", "sha", copy).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
