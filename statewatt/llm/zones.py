"""Exact centroid clustering over zone maps along a Hilbert curve.

Vectors are integers. They are laid out once in the order of a Hilbert curve
through their quantised components, in blocks of neighbours whose first row
carries the least and greatest value of every dimension. A round reads the
blocks: the box tells which centroids can be nearest to any vector in it, and
only with those are the vectors compared, exactly. A task returns sums for each
centroid, so rounds move a few numbers and no vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewatt.session import stored

K, ROUNDS, SEED = 8, 10, "3"
#: Rows of a block; bits of a component on the curve.
BLOCK_ROWS = 512
BITS = 4


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places on a Hilbert curve, as byte strings in the same order, of rows of
    cell numbers below 2**bits. The axes are turned and mirrored from the
    highest bit down, then Gray-decoded, and their bits interleaved."""
    x = cells.astype(np.uint32).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = np.uint32((1 << b) - 1)
        for i in range(n):
            mirrored = (x[i] >> np.uint32(b)) & np.uint32(1) == 1
            swap = np.where(mirrored, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(mirrored, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint32(b)) & np.uint32(1) == 1, np.uint32((1 << b) - 1), np.uint32(0))
    x ^= turn
    planes = np.concatenate([((x >> np.uint32(b)) & np.uint32(1)).T for b in range(bits - 1, -1, -1)], axis=1)
    return [row.tobytes() for row in np.packbits(planes.astype(np.uint8), axis=1)]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def _extremes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    low = high = None
    for batch in batches:
        if batch.num_rows:
            v = _matrix(batch.column(0))
            low = v.min(0) if low is None else np.minimum(low, v.min(0))
            high = v.max(0) if high is None else np.maximum(high, v.max(0))
    if low is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(low)), pa.int32()), pa.array(low), pa.array(high)], ["dim", "low", "high"])


def extremes(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest value of each dimension of ``v``."""
    found = vectors.select("v").mapInArrow(_extremes, "dim int, low long, high long").groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    rows = sorted(found.collect())  # a row for each dimension
    return np.array([r["low"] for r in rows], np.int64), np.array([r["high"] for r in rows], np.int64)


def zone_blocks(vectors: DataFrame, block_rows: int = BLOCK_ROWS, bits: int = BITS) -> DataFrame:
    """(vec_id, v, block, low, high), stored in the order of the curve. ``block``
    counts the blocks of a partition; ``low`` and ``high`` stand at a block's
    first row. Vectors in one place of the curve are told apart by their id, so
    a third of all rows in one place are still many partitions."""
    low, high = extremes(vectors)
    width = np.maximum((high.astype(float) - low.astype(float)) / (1 << bits), 1.0)

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = np.clip((_matrix(batch.column(1)) - low.astype(float)) // width, 0, (1 << bits) - 1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_keys(cells, bits), pa.binary())], ["vec_id", "v", "key"])

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Zones are known when a block is whole, so rows wait for that."""
        number, held = 0, []
        for batch in batches:
            held.append(batch.select(["vec_id", "v"]))
            while sum(b.num_rows for b in held) >= block_rows:
                table = pa.Table.from_batches(held).combine_chunks()
                yield _block(table.slice(0, block_rows), number)
                number += 1
                held = table.slice(block_rows).to_batches()
        if sum(b.num_rows for b in held):
            yield _block(pa.Table.from_batches(held).combine_chunks(), number)

    shape = T.StructType([vectors.schema["vec_id"], T.StructField("v", T.ArrayType(T.LongType()))])
    onto = vectors.select("vec_id", "v").mapInArrow(keyed, T.StructType([*shape, T.StructField("key", T.BinaryType())]))
    order = ["key", F.xxhash64("vec_id", "v"), "vec_id"]
    laid = onto.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "v")
    lists = [T.StructField(n, T.ArrayType(T.LongType())) for n in ("low", "high")]
    return stored(laid.mapInArrow(mapped, T.StructType([*shape, T.StructField("block", T.LongType()), *lists])))


def _block(table: pa.Table, number: int) -> pa.RecordBatch:
    batch = table.combine_chunks().to_batches()[0]
    v = _matrix(batch.column(1))
    zones = [pa.array([x.tolist()] + [None] * (len(v) - 1), pa.list_(pa.int64())) for x in (v.min(0), v.max(0))]
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(v), number)), *zones], ["vec_id", "v", "block", "low", "high"])


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a vector in the box, ties
    to the smaller number. The one whose farthest corner is nearest beats
    another if it is nearer everywhere in the box: the difference of the two
    squared distances is linear, so its greatest value lies at a corner."""
    far = np.maximum(abs(centroids - low), abs(high - centroids))
    best = int(np.argmin((far * far).sum(1)))
    apart = 2 * (centroids - centroids[best])
    worst = np.where(apart > 0, apart * high, apart * low).sum(1) + (centroids[best] ** 2).sum() - (centroids**2).sum(1)
    number = np.arange(len(centroids))
    return number[~((worst < 0) | (worst == 0) & (number > best))]


def _nearest(batch: pa.RecordBatch, centroids: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors, clusters, squared distances) of a batch, block by block. The
    rows of a block that was cut by a batch or a file split have no zone and get
    one from what is there of it."""
    v = _matrix(batch.column(1)).astype(kind)
    block = np.asarray(batch.column(2))
    cluster, distance = np.empty(len(v), np.int64), np.empty(len(v), kind)
    zoned = np.asarray(batch.column(3).is_valid())
    starts = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | zoned[1:]])
    for a, b in zip(starts, [*starts[1:], len(v)]):
        if zoned[a]:
            low, high = (np.array(batch.column(c)[int(a)].as_py(), kind) for c in (3, 4))
        else:
            low, high = v[a:b].min(0), v[a:b].max(0)
        few = candidates(low, high, centroids)
        best = np.full(b - a, few[0])
        least = ((v[a:b] - centroids[few[0]]) ** 2).sum(1)
        for c in few[1:]:
            other = ((v[a:b] - centroids[c]) ** 2).sum(1)
            nearer = other < least
            best[nearer], least[nearer] = c, other[nearer]
        cluster[a:b], distance[a:b] = best, least
    return v, cluster, distance


def _tally(blocks: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """Of each non-empty cluster: rows, summed distance and summed components.
    Tasks add up; what comes back is a row for each centroid and dimension."""
    kind = centroids.dtype

    def tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centroids.shape
        rows, spread, sums = [0] * k, [0] * k, np.zeros((k, dims), object)
        for batch in batches:
            v, cluster, distance = _nearest(batch, centroids, kind)
            for c in np.unique(cluster):
                own = cluster == c
                rows[c] += int(own.sum())
                spread[c] += int(distance[own].sum())
                sums[c] += v[own].sum(0).astype(object)
        found = [(c, d, rows[c], spread[c], int(sums[c, d])) for c in range(k) if rows[c] for d in range(dims)]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)] or [pa.array([], pa.int64())] * 5, ["cluster", "dim", "rows", "spread", "total"])

    parts = blocks.mapInArrow(tally, "cluster long, dim long, rows long, spread long, total long")
    found = parts.groupBy("cluster", "dim").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("rows", "spread", "total")])
    out: dict[int, tuple[int, int, list[int]]] = {}
    for r in sorted(found.collect()):
        out.setdefault(r["cluster"], (int(r["rows"]), int(r["spread"]), []))[2].append(int(r["total"]))
    return out


def _numbers(rows: list[list[int]], most: int) -> np.ndarray:
    """Centroids as longs where squared distances cannot overflow, else as any integers."""
    dims = len(rows[0])
    return np.array(rows, np.int64 if 16 * dims * (most + 1) ** 2 < 1 << 62 else object)


def start(vectors: DataFrame, k: int = K, seed: str = SEED) -> list[list[int]]:
    """The k vectors with the smallest hash of seed and id, in that order, all if
    there are fewer; rows with a null id come last, then the smaller vector."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r["v"]) for r in vectors.select(name.alias("name"), "v").orderBy(F.col("name").asc_nulls_last(), "v").limit(k).collect()]


def clusters(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: str = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row (vec_id, v): vec_id, cluster, distance, cluster_inertia,
    inertia, centroid_sha256, after ``rounds`` rounds of exact integer k-means
    and a last assignment.

    ``v`` has the same number of components in every row, none null. Ties go to
    the smaller number; an empty cluster keeps its centroid; means are floored.
    Rows alike are rows of their own. With fewer than ``k`` rows each is a
    centroid at first; an empty table gives an empty result. Squared distances and
    their sums must fit a long, else the job fails.
    """
    schema = T.StructType(
        [vectors.schema["vec_id"], T.StructField("cluster", T.IntegerType())]
        + [T.StructField(n, T.LongType()) for n in ("distance", "cluster_inertia", "inertia")]
        + [T.StructField("centroid_sha256", T.StringType())]
    )
    spark = vectors.sparkSession
    blocks = zone_blocks(vectors, block_rows)
    first = start(blocks, k, seed)
    if not first:
        return spark.createDataFrame([], schema)
    low, high = extremes(blocks)
    most = int(max(abs(int(low.min())), abs(int(high.max()))))
    centroids = _numbers(first, most)
    for _ in range(rounds):
        for c, (n, _, total) in _tally(blocks, centroids).items():
            centroids[c] = [t // n for t in total]
    inertia = {c: spread for c, (_, spread, _) in _tally(blocks, centroids).items()}
    names = [hashlib.sha256(",".join(str(int(x)) for x in row).encode()).hexdigest() for row in centroids]

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, cluster, distance = _nearest(batch, centroids, centroids.dtype)
                own = cluster.tolist()
                columns = [pa.array([int(x) for x in distance], pa.int64()), pa.array([inertia[c] for c in own], pa.int64()), pa.array([sum(inertia.values())] * len(own), pa.int64())]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.int32()), *columns, pa.array([names[c] for c in own], pa.string())], schema.names)

    return blocks.mapInArrow(assign, schema)
