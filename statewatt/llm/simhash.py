"""Near-duplicates by SimHash and a Gray-order hierarchical index.

Fingerprints that differ in at most ``k`` of 64 bits agree on one of k + 1
blocks of bits, so each distinct fingerprint enters k + 1 tables, keyed by one
block. Within such a cell the fingerprints, rotated so that the block leads,
are sorted by Gray rank; runs of neighbours become upper nodes that hold the
bits their members share, and a pair of nodes is dropped with all below it as
soon as the shared bits alone differ too often. A node pair that cannot differ
too often is linked as a whole. What leaves a cell is one link a fingerprint,
not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewatt.llm.common import cut, pick
from statewatt.llm.components import components

SEED = 42
#: Fingerprints of a cell; a cell with more is split into slices that meet in pairs.
CELL_ROWS = 2048
#: Fingerprints below one upper node of the next level.
FANOUT = 4


def fingerprint(text: str | bytes | None, width: int = 3) -> int:
    """The SimHash of a whole text; no words give zero."""
    raw = text.encode() if isinstance(text, str) else (text or b"")
    words = raw.lower().split()
    if not words:
        return 0
    hashed, join = xxhash.xxh64_intdigest, b" ".join
    shingles = [join(words)] if len(words) < width else map(join, zip(*(words[i:] for i in range(width))))
    values = np.fromiter((hashed(s, SEED) for s in shingles), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(values), 1 << 15):
        part = values[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(values), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, key, fp) of every row; key is a hash of the text as it is, fp
    holds the 64 bits as a long."""
    few = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("key", F.xxhash64("text"))
    schema = T.StructType([T.StructField("doc_id", few.schema["doc_id"].dataType), T.StructField("key", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.fromiter((fingerprint(t.as_py(), width) for t in texts), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found.view(np.int64))], ["doc_id", "key", "fp"])

    return few.mapInArrow(run, schema)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each code in the Gray sequence."""
    x = x.copy()
    for by in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(by)
    return x


def _rotated(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    by = by.astype(np.uint64)
    return (x << by) | (x >> ((np.uint64(64) - by) & np.uint64(63)))


class GrayIndex:
    """Levels of nodes over fingerprints that are sorted by (cell, Gray rank).

    Level 0 holds the fingerprints; a node above covers up to ``FANOUT`` nodes
    of one cell. ``mask`` has the bits on which all below agree, ``bits`` their
    values there.
    """

    def __init__(self, cell: np.ndarray, codes: np.ndarray) -> None:
        full = np.full(len(codes), ~np.uint64(0))
        self.levels = [(cell, codes, full, np.arange(len(codes) + 1))]
        while True:
            cell, bits, mask, _ = self.levels[-1]
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            sizes = np.diff(np.r_[starts, len(cell)])
            if (sizes == 1).all():
                break
            within = np.arange(len(cell)) - np.repeat(starts, sizes)
            heads = np.flatnonzero(within % FANOUT == 0)
            ones = np.bitwise_and.reduceat(bits | ~mask, heads)
            zeros = np.bitwise_and.reduceat(~bits | ~mask, heads)
            shared = np.bitwise_and.reduceat(mask, heads) & (ones | zeros)
            self.levels.append((cell[heads], ones & shared, shared, np.r_[heads, len(cell)]))

    def links(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of level-0 places that connect whatever is within ``k`` bits."""
        top = len(self.levels) - 1
        a = b = np.arange(len(self.levels[top][0]))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for level in range(top, -1, -1):
            _, bits, mask, below = self.levels[level]
            both = mask[a] & mask[b]
            apart = np.bitwise_count((bits[a] ^ bits[b]) & both)  # differences that all below have
            free = 64 - np.bitwise_count(both).astype(np.int64)
            near = apart <= k
            if level == 0:
                hit = near & (a != b)
                found.append((a[hit], b[hit]))
                break
            whole = near & (apart + free <= k)  # every two below are within k
            for x in (a[whole], b[whole]):
                found.append(self._chain(level, x))
            found.append((self._first(level, a[whole]), self._first(level, b[whole])))
            go = near & ~whole
            a, b = a[go], b[go]
            na, nb = below[a + 1] - below[a], below[b + 1] - below[b]
            n = na * nb
            pair = np.repeat(np.arange(len(a)), n)
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            ca, cb = below[a][pair] + at // nb[pair], below[b][pair] + at % nb[pair]
            once = ca <= cb  # of a node with itself, each pair of children once
            a, b = ca[once], cb[once]
        x, y = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        return x[x != y], y[x != y]

    def _first(self, level: int, nodes: np.ndarray) -> np.ndarray:
        for up in range(level, 0, -1):
            nodes = self.levels[up][3][nodes]
        return nodes

    def _chain(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All fingerprints below a node, linked one to the next."""
        nodes = np.unique(nodes)
        first, end = self._first(level, nodes), self._first(level, nodes + 1)
        n = end - first - 1
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        return at, at + 1


def local_roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each of n places the smallest one connected to it."""
    root = np.arange(n)
    while True:
        rx, ry = root[x], root[y]
        low = np.minimum(rx, ry)
        if (rx == ry).all():
            return root
        np.minimum.at(root, rx, low)
        np.minimum.at(root, ry, low)
        while (root[root] != root).any():
            root = root[root]


def _links_of(cell: np.ndarray, table: np.ndarray, fp: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    codes = _rotated(fp, table * width)
    order = np.lexsort((gray_rank(codes), cell))
    cell, codes, fp = cell[order], codes[order], fp[order]
    x, y = GrayIndex(cell, codes).links(k)
    root = local_roots(len(fp), x, y)
    moved = np.flatnonzero(root != np.arange(len(fp)))
    return fp[moved], fp[root[moved]]


def _link_cells(batches: Iterable[pa.RecordBatch], k: int, width: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell; whole cells are indexed together, a bounded number at a time."""

    def out(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(parts)
        new = np.r_[True, (rows[1:, :4] != rows[:-1, :4]).any(1)]
        cell = np.cumsum(new) - 1
        sizes = np.bincount(cell)
        cost = np.cumsum(sizes.astype(np.int64) ** 2)
        group = (cost // 8_000_000)[cell]  # pairs that one index may meet at worst
        rows, cell, group = (v[sizes[cell] > 1] for v in (rows, cell, group))
        for g in np.unique(group):
            own = group == g
            a, b = _links_of(cell[own], rows[own, 0], rows[own, 4].view(np.uint64), k, width)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    held: list[np.ndarray] = []
    for batch in batches:
        rows = np.stack([np.asarray(c) for c in batch.columns], axis=1) if batch.num_rows else np.empty((0, 5), np.int64)
        if not len(rows):
            continue
        last = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1))
        if len(last) and sum(map(len, held)) + len(rows) > 32_768:
            head, tail = rows[: last[-1] + 1], rows[last[-1] + 1 :]
            yield from out([*held, head])
            held = [tail]
        else:
            held.append(rows)
    if held:
        yield from out(held)


def near_links(codes: DataFrame, k: int = 3, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints ``fp`` within ``k`` bits.

    Block keys that hold more than ``cell_rows`` fingerprints are dealt into
    slices; each two slices form a cell, so no pair is missed and none of the
    cells grows with the data.
    """
    if not 0 <= k <= 15:
        raise ValueError("k must be from 0 to 15")
    width = 64 // (k + 1)

    def block(t: int) -> Column:
        lead = F.shiftrightunsigned(F.col("fp"), 64 - width * (t + 1)) if width * (t + 1) < 64 else F.col("fp")
        return lead.bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1).cast("long"))

    tables = F.array(*[F.struct(F.lit(t).cast("long").alias("t"), block(t).alias("key")) for t in range(k + 1)])
    rows = codes.select("fp", F.inline(tables))
    hot = cut(rows.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > cell_rows).select("t", "key", F.ceil(2 * F.col("n") / F.lit(cell_rows)).cast("long").alias("slices")))
    rows = rows.join(hot, ["t", "key"], "left")
    own = F.pmod(F.xxhash64("fp"), F.col("slices"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1), lambda s: s != F.col("own"))
    cells = F.when(F.col("slices").isNull(), F.array(F.struct(F.lit(0).cast("long").alias("s1"), F.lit(0).cast("long").alias("s2")))).otherwise(
        F.transform(others, lambda s: F.struct(F.least(s, F.col("own")).alias("s1"), F.greatest(s, F.col("own")).alias("s2")))
    )
    rows = rows.withColumn("own", own).select("t", "key", "fp", F.inline(cells)).select("t", "key", "s1", "s2", "fp")
    keys = ["t", "key", "s1", "s2"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda it: _link_cells(it, k, width), "a long, b long")


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int, k: int, cell_rows: int) -> DataFrame:
    """(doc_id, key, fp, root, component_id); root is the smallest fingerprint reachable."""
    own = cut(fingerprints(docs, id_col, text_col, width))
    codes = cut(own.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = components(near_links(codes, k, cell_rows), "a", "b").select(F.col("node").alias("fp"), "root")
    linked = cut(codes.join(linked, "fp"))
    smallest = cut(linked.groupBy("root").agg(F.min("least").alias("component_id")))
    joined = linked.select("fp", "root").join(smallest, "root")
    root, first = F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id"))
    of_code = cut(codes.join(joined, "fp", "left").select("fp", root, first.alias("component_id")))
    return own.join(of_code, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, k: int = 3, cell_rows: int = CELL_ROWS) -> DataFrame:
    """doc_id, fingerprint and component_id, one row per row of ``docs``.

    component_id is the smallest id that can be reached over links of at most
    ``k`` differing bits, the row's own included. Null and wordless texts have
    fingerprint zero and link like any other. A row with a null id takes part
    and gets the component of its fingerprint; the null itself is never the
    smallest id, unless there is no other.
    """
    found = _grouped(docs, id_col, text_col, width, k, cell_rows)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, k: int = 3, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that stand for their
    component: the smallest id, a null one last, and of equal ids one text by
    its hash. Of rows alike in id and text one stays."""
    found = _grouped(docs, id_col, text_col, width, k, cell_rows)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    kept = cut(found.groupBy("root").agg(F.min(place).alias("p")).select(F.col("p.doc_id").alias("_i"), F.col("p.key").alias("_k")).distinct())
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    i, t = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    stay = flat.join(kept, F.col(i).eqNullSafe(F.col("_i")) & (F.xxhash64(t) == F.col("_k")), "left_semi")
    return stay.dropDuplicates([i, t]).toDF(*docs.columns)
