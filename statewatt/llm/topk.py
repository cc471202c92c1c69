"""Exact top-k inner products by vector-approximation files.

Vectors are integers. A shard keeps, beside them, a few bits a dimension: the
cell each component lies in. Scanning the cells bounds every inner product from
both sides; the exact vectors are then read in the order of their bound until
the k-th exact score beats every bound that is left. Shards and query blocks
have a fixed size, and each pair of them is one group, so nothing is broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statewatt.llm.common import cut, pick

K = 20
#: Rows of a shard, queries of a block, and shards at least, so that few rows
#: still make use of several machines.
SHARD_ROWS = 65_536
QUERY_ROWS = 8_192
LEAST_SHARDS = 16
#: Bits of a cell number, and queries whose bounds are held at once.
BITS = 4
SCAN_ROWS = 128


class VaFile:
    """Cells and exact vectors of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, bits: int = BITS) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.low = vectors.min(0)
        span = vectors.max(0).astype(object) - self.low.astype(object) + 1  # exact for any longs
        self.width = np.maximum(1, -(-span // (1 << bits))).astype(np.int64)
        self.cells = ((self.vectors - self.low) // self.width).astype(np.uint8)
        self.most = int(np.abs(vectors.astype(float)).max()) + 1

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product that the cells allow, rounded outward."""
        near = self.low.astype(float) + self.cells * self.width.astype(float)
        half = (self.width - 1) / 2.0
        q = queries.astype(float)
        middle = q @ (near + half).T
        slack = (np.abs(q) @ half)[:, None]
        error = 1e-12 * (np.abs(q) @ (np.abs(near).max(0) + self.width))[:, None] + 1e-9
        return middle - slack - error, middle + slack + error

    def exact(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if self.most * (int(np.abs(query.astype(float)).max()) + 1) * len(query) < 1 << 62:
            return self.vectors[rows] @ query
        return (self.vectors[rows].astype(object) @ query.astype(object)).astype(np.int64)  # raises beyond a long

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query_id, vec_id, score) of the shard's k best for each query."""
        out: list[tuple[np.ndarray, ...]] = []
        self.read = 0
        for at in range(0, len(queries), SCAN_ROWS):
            part, part_ids = queries[at : at + SCAN_ROWS], query_ids[at : at + SCAN_ROWS]
            low, high = self.bounds(part)
            own = self.ids[None, :] == part_ids[:, None]
            low[own] = high[own] = -np.inf
            for i, q in enumerate(part):
                n = min(k, len(self.ids) - int(own[i].sum()))
                if n <= 0:
                    continue
                sure = np.partition(low[i], len(self.ids) - n)[len(self.ids) - n]  # n vectors reach it
                rows = np.flatnonzero((high[i] >= sure) & ~own[i])
                rows = rows[np.lexsort((rows, -high[i][rows]))]
                best = np.empty(0, np.int64)
                scores = np.empty(0, np.int64)
                for start in range(0, len(rows), 4 * k):
                    if len(best) == n and high[i][rows[start]] < scores[-1]:
                        break
                    more = rows[start : start + 4 * k]
                    self.read += len(more)
                    best, scores = np.r_[best, more], np.r_[scores, self.exact(q, more)]
                    order = np.lexsort((best, -scores))[:n]  # rows are in id order
                    best, scores = best[order], scores[order]
                out.append((np.full(len(best), part_ids[i]), self.ids[best], scores))
        if not out:
            none = np.empty(0, np.int64)
            return none, none, none
        return tuple(np.concatenate(c) for c in zip(*out))


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """(vec_id, v): components floor(scale · x) as longs, of rows that take part.

    Null ids and vectors, and vectors that are empty or hold a null, infinite or
    not-a-number component, take none. Of rows that share an id the smallest
    vector counts.
    """
    few = pick(rows, id_col, vector_col).toDF("vec_id", "x")
    x = F.transform("x", lambda e: e.cast("double"))
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    few = few.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & F.coalesce(fine, F.lit(False)))
    few = few.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e * scale).cast("long")).alias("v"))
    return few.groupBy("vec_id").agg(F.min("v").alias("v"))


def _search(table: pa.Table, k: int) -> pa.Table:
    asks = np.asarray(table.column("asks"))
    ids = np.asarray(table.column("vec_id"))
    lists = table.column("v").combine_chunks()
    flat = np.asarray(lists.flatten() if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks).flatten())
    vectors = flat.reshape(len(ids), -1)
    rows, queries = ~asks, asks
    if rows.any() and queries.any():
        q, v, s = VaFile(ids[rows], vectors[rows]).search(ids[queries], vectors[queries], k)
    else:
        q = v = s = np.empty(0, np.int64)
    return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.int64())})


def top_k(vectors: DataFrame, asks: Column, k: int = K, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``asks`` holds, its k
    best other rows of (vec_id, v) by inner product, ties to the smaller id.

    Vectors are only compared with those of as many dimensions. A query with
    fewer than k others gets them all, one without any gets no row. Scores must
    fit a long.
    """
    own = cut(vectors.withColumn("asks", asks).withColumn("dims", F.size("v")))
    counts = own.agg(F.count("*").alias("n"), F.sum(F.col("asks").cast("long")).alias("q")).first()
    shards = max(LEAST_SHARDS, -(-counts["n"] // shard_rows))
    blocks = max(1, -(-(counts["q"] or 0) // query_rows))
    spread = F.xxhash64("vec_id")
    rows = own.withColumn("shard", F.pmod(spread, F.lit(shards))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = rows.select("dims", "shard", F.col("block").cast("long").alias("block"), F.lit(False).alias("asks"), "vec_id", "v")
    queries = own.where("asks").withColumn("block", F.pmod(spread, F.lit(blocks))).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    queries = queries.select("dims", F.col("shard").cast("long").alias("shard"), "block", "asks", "vec_id", "v")
    found = rows.unionAll(queries).groupBy("dims", "shard", "block").applyInArrow(lambda t: _search(t, k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
