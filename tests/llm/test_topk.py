from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from statewatt.llm import topk


def vectors(n=400, d=8, seed=2, scale=1.0):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=d) * scale).astype("float32").tolist(), 0) for i in range(n)]
    hot = rows[7][1]
    rows += [(1000 + i, hot, 0) for i in range(100)]
    rows += [(2000, None, 0), (2020, [], 0), (2040, [float("nan")] * d, 0), (2060, [None] * d, 0), (2080, [float("inf")] + [0.0] * (d - 1), 0), (None, hot, 0)]
    rows += [(3000, [1.0, 2.0], 0), (3001, [2.0, 1.0], 0), (4000, [3.0] * 5, 0), (20, rows[20][1], 1)]
    return rows


def brute(rows, k):
    own = {}
    for i, x, _ in rows:
        if i is None or not x or any(v is None or not math.isfinite(v) for v in x):
            continue
        v = [math.floor(64 * v) for v in x]
        own[i] = min(own.get(i, v), v)
    out = []
    for q in own:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(own[q], v)), i) for i, v in own.items() if i != q and len(v) == len(own[q]))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale,shard,block", [(1.0, 65_536, 8_192), (1.0, 10, 7), (1e6, 65_536, 8_192), (0.0, 65_536, 8_192)])
def test_is_brute_force(spark, scale, shard, block):
    df = spark.createDataFrame(vectors(scale=scale), "vec_id long, embedding array<float>, label int").repartition(5)
    wide = df.select("*", F.col("label").alias("v"), F.col("label").alias("Embedding"), F.col("label").alias("rank"))
    found = topk.top_k(topk.whole_vectors(wide), F.col("vec_id") % 20 == 0, shard_rows=shard, query_rows=block).collect()
    assert sorted(map(tuple, found)) == brute(vectors(scale=scale), 20)


def test_bounds_hold_and_spare_reads():
    rng = np.random.default_rng(1)
    v = (rng.normal(size=(3000, 16)) * 40).astype(np.int64)
    file = topk.VaFile(np.arange(3000), v, bits=6)
    low, high = file.bounds(v[:50])
    exact = v[:50] @ v.T
    assert (low <= exact).all() and (exact <= high).all()
    file.search(np.arange(50), v[:50], 20)
    assert file.read < 50 * 3000 / 4


def test_empty_table(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(topk.whole_vectors(none), F.col("vec_id") % 20 == 0).count() == 0
