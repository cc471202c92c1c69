"""Hard negatives by threshold joins over partial inverted indexes.

Vectors are integers; a shard orders its dimensions by falling energy. For a
threshold t the index lists a vector under its first dimensions only: those
behind are left out as soon as the norm of the rest times the query's cannot
reach t, so a pair at t or above must meet in a list. Partial scores are
accumulated list by list, pairs go as soon as the norms that remain cannot
lift them to t, and what is left is completed from the dimensions left out.

Thresholds start high and are lowered, each time for the queries whose windows
are not full yet. Anchors first find their positives so, and then, below each
positive's score, their negatives. Shards and query blocks have a fixed size and
each pair of them is one group, so nothing is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statewatt.llm.common import cut

POSITIVES, NEGATIVES = 5, 5
#: A negative scores from this share of the positive's score, in percent, up to it.
LEAST_PERCENT = 80
#: Rows of a shard, queries of a block, and shards at least, so that few rows
#: still make use of several machines.
SHARD_ROWS = 65_536
QUERY_ROWS = 32_768
LEAST_SHARDS = 12
#: Dimensions whose lists are added at once, queries that are scored at once.
STEP = 8
SCAN_ROWS = 128
#: Thresholds on the way down, as shares: of the highest score that norms allow
#: for positives, of the way from a positive's score to its floor for negatives.
POSITIVE_STEPS = (0.7, 0.5, 0.35, 0.2, 0.1, 0.0)
NEGATIVE_STEPS = (0.25, 0.5, 0.75, 1.0)


def _suffix_norms(v: np.ndarray) -> np.ndarray:
    """Norms of v[:, STEP * s:] for every step s, rounded up; the last are zero."""
    squares = v.astype(float) ** 2
    parts = np.add.reduceat(squares, range(0, v.shape[1], STEP), axis=1)
    rest = np.cumsum(parts[:, ::-1], axis=1)[:, ::-1]
    return np.c_[np.sqrt(rest) * (1 + 1e-9), np.zeros(len(v))]


class PartialIndex:
    """One shard's vectors and, for any threshold, lists of their first dimensions."""

    def __init__(self, vectors: np.ndarray, most: int) -> None:
        """``most`` bounds the components of all queries."""
        largest = int(np.abs(vectors.astype(float)).max(initial=0)) + 1
        bound = largest * (most + 1) * vectors.shape[1]
        # doubles where every sum of products is exact, else longs, else any integers
        self.kind = np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 62 else object
        energy = (vectors.astype(float) ** 2).sum(0)
        self.order = np.argsort(-energy, kind="stable")
        self.v = vectors[:, self.order].astype(self.kind)
        self.norms = _suffix_norms(self.v)
        self.listed = 0

    def prepared(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q = queries[:, self.order].astype(self.kind)
        return q, _suffix_norms(q)

    def reach(self, q: np.ndarray, norms: np.ndarray, least: np.ndarray, keys: np.ndarray, banned: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, rows, scores) of all pairs that score ``least`` or more;
        ``least`` is one float a query. A row whose key is a query's
        ``banned`` one is none of its pairs."""
        with np.errstate(divide="ignore", invalid="ignore"):
            share = least / norms[:, 0]
        # a query of norm zero scores zero with every row
        share[norms[:, 0] == 0] = np.where(least[norms[:, 0] == 0] > 0, np.inf, -np.inf)
        share[np.isnan(share)] = -np.inf
        steps = self.norms.shape[1] - 1
        tau = share.min()
        listed = np.full(len(self.v), steps) if tau <= 0 else (self.norms[:, :steps] >= tau * (1 - 1e-9)).sum(1)
        rows = np.argsort(-listed, kind="stable")
        rows = rows[: int((listed > 0).sum())]
        self.listed += int(listed.sum())
        score = np.zeros((len(q), len(rows)), self.kind)
        alive = keys[rows][None, :] != banned[:, None]
        floor = least[:, None] - 1e-6
        for s in range(steps):
            n = int((listed[rows] > s).sum())  # the list: rows come in falling order of their lists
            if not n:
                break
            at = slice(s * STEP, (s + 1) * STEP)
            score[:, :n] += q[:, at] @ self.v[rows[:n], at].T
            alive[:, :n] &= score[:, :n].astype(float) + norms[:, s + 1, None] * self.norms[rows[:n], s + 1] * (1 + 1e-9) >= floor
            stays = alive.any(0)
            if stays.mean() < 0.8:
                rows, score, alive = rows[stays], score[:, stays], alive[:, stays]
        for s in np.unique(listed[rows]):
            if s < steps:
                rest = np.flatnonzero(listed[rows] == s)
                score[:, rest] += q[:, s * STEP :] @ self.v[rows[rest], s * STEP :].T
        alive &= score >= least[:, None]
        for i in range(len(q)):
            hit = np.flatnonzero(alive[i])
            yield i, rows[hit], score[i, hit].astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def nearest(index: PartialIndex, ids: np.ndarray, keys: np.ndarray, queries: np.ndarray, banned: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, scores) of each query's k best rows, all if there are fewer."""
    for start in range(0, len(queries), SCAN_ROWS):
        q, norms = index.prepared(queries[start : start + SCAN_ROWS])
        own = banned[start : start + SCAN_ROWS]
        open_ = np.arange(len(q))
        top = index.norms[:, 0].max(initial=0) * norms[:, 0]
        for share in (*POSITIVE_STEPS, None):
            least = np.full(len(open_), -np.inf) if share is None else np.ceil(top[open_] * share)
            left = []
            for i, rows, scores in index.reach(q[open_], norms[open_], least, keys, own[open_]):
                if len(rows) < k and share is not None:
                    left.append(open_[i])
                elif len(rows):
                    best = _best(ids[rows], scores, k)
                    yield start + int(open_[i]), ids[rows][best], scores[best]
            open_ = np.array(left, np.int64)
            if not len(open_):
                break


def below(index: PartialIndex, ids: np.ndarray, keys: np.ndarray, queries: np.ndarray, banned: np.ndarray, caps: list[list[int]], k: int, percent: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(query, cap, ids, scores): for each score in a query's ``caps`` its k best
    rows that score no more than it and ``percent`` of it at least."""
    for start in range(0, len(queries), SCAN_ROWS):
        q, norms = index.prepared(queries[start : start + SCAN_ROWS])
        own = banned[start : start + SCAN_ROWS]
        floors = [{c: -(-c * percent // 100) for c in caps[start + i]} for i in range(len(q))]
        open_ = {i: set(f) for i, f in enumerate(floors) if f}
        for share in NEGATIVE_STEPS:
            todo = np.array(sorted(open_), np.int64)
            if not len(todo):
                break
            level = {i: {c: c - (c - floors[i][c]) * share for c in open_[i]} for i in open_}
            least = np.array([float(min(level[i].values())) for i in todo.tolist()])
            for at, rows, scores in index.reach(q[todo], norms[todo], np.ceil(least), keys, own[todo]):
                i = int(todo[at])
                for c in list(open_[i]):
                    window = np.flatnonzero((scores <= c) & (scores >= floors[i][c]))
                    if len(window) >= k or least[at] <= floors[i][c]:
                        best = window[_best(ids[rows[window]], scores[window], k)]
                        if len(best):
                            yield start + i, c, ids[rows[best]], scores[best]
                        open_[i].discard(c)
                if not open_[i]:
                    del open_[i]


def _matrix(table: pa.Table) -> np.ndarray:
    lists = table.column("v").combine_chunks()
    flat = lists.flatten() if not isinstance(lists, pa.ChunkedArray) else pa.concat_arrays([c.flatten() for c in lists.chunks])
    return np.asarray(flat).reshape(table.num_rows, -1)


def _longs(*columns: list[np.ndarray]) -> list[pa.Array]:
    return [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in columns]


def _split(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    asks = table.column("asks")
    return table.filter(pc.invert(asks)), table.filter(asks)


def _positives(table: pa.Table, k: int) -> pa.Table:
    rows, queries = _split(table)
    out: tuple[list, ...] = ([], [], [])
    if rows.num_rows and queries.num_rows:
        q, ids, own = _matrix(queries), np.asarray(rows.column("vec_id")), np.asarray(queries.column("row"))
        index = PartialIndex(_matrix(rows), int(np.abs(q.astype(float)).max()))
        for i, found, scores in nearest(index, ids, np.asarray(rows.column("row")), q, own, k):
            for c, x in zip(out, (np.full(len(found), own[i]), found, scores)):
                c.append(x)
    return pa.table(_longs(*out), ["row", "positive_id", "positive_score"])


def _negatives(table: pa.Table, k: int, percent: int) -> pa.Table:
    rows, queries = _split(table)
    out: tuple[list, ...] = ([], [], [], [])
    if rows.num_rows and queries.num_rows:
        q, ids, own = _matrix(queries), np.asarray(rows.column("vec_id")), np.asarray(queries.column("row"))
        labels = [np.asarray(t.column("label")) for t in (rows, queries)]
        index = PartialIndex(_matrix(rows), int(np.abs(q.astype(float)).max()))
        for i, cap, found, scores in below(index, ids, labels[0], q, labels[1], queries.column("caps").to_pylist(), k, percent):
            for c, x in zip(out, (np.full(len(found), own[i]), np.full(len(found), cap), found, scores)):
                c.append(x)
    return pa.table(_longs(*out), ["row", "positive_score", "negative_id", "negative_score"])


def hard_negatives(
    vectors: DataFrame, asks: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = LEAST_PERCENT, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    of rows (vec_id, label, v), none of which is null.

    Anchors are the rows where ``asks`` holds. An anchor's positives are its
    ``positives`` best other rows of its label by inner product, ties to the
    smaller id; for each, its negatives are the ``negatives`` best rows of other
    labels that score from ``percent`` of the positive's score up to that score,
    so a positive below zero has none. Rows that share an id are rows of their own. Vectors
    meet only those of as many dimensions. Scores must fit a long.
    """
    own = vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.col("label").cast("long").alias("label"), "v", F.size("v").alias("dims"))
    own = cut(own.withColumn("asks", F.coalesce(asks, F.lit(False))))
    counts = own.agg(F.count("*").alias("n"), F.sum(F.col("asks").cast("long")).alias("q")).first()
    shards = max(LEAST_SHARDS, -(-counts["n"] // shard_rows))
    blocks = max(1, -(-(counts["q"] or 0) // query_rows))
    spread = F.xxhash64("row")
    none = F.lit(None).cast("array<long>").alias("caps")

    def dealt(queries: DataFrame) -> DataFrame:
        """Rows once for each block of queries, queries once for each shard."""
        rows = own.withColumn("shard", F.pmod(spread, F.lit(shards))).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        asked = queries.withColumn("block", F.pmod(spread, F.lit(blocks))).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
        names = ["dims", "label", "shard", "block", "row", "vec_id", "v"]
        return rows.select(*names, none, F.lit(False).alias("asks")).unionAll(asked.select(*names, "caps", F.lit(True).alias("asks")))

    anchors = own.where("asks")
    found = dealt(anchors.withColumn("caps", none)).groupBy("dims", "label", "shard", "block")
    found = found.applyInArrow(lambda t: _positives(t, positives), "row long, positive_id long, positive_score long")
    best = Window.partitionBy("row").orderBy(F.col("positive_score").desc(), "positive_id")
    chosen = cut(found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives))

    caps = chosen.where("positive_score >= 0").groupBy("row").agg(F.collect_set("positive_score").alias("caps"))
    found = dealt(anchors.join(caps, "row")).groupBy("dims", "shard", "block")
    found = found.applyInArrow(lambda t: _negatives(t, negatives, percent), "row long, positive_score long, negative_id long, negative_score long")
    best = Window.partitionBy("row", "positive_score").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    told = chosen.join(ranked, ["row", "positive_score"]).join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return told.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
