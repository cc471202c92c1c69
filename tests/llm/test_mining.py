from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from statewatt.llm import mining
from statewatt.llm.common import integer_vectors

ROWS = "vec_id long, label int, v array<long>"


def brute(rows, asks, positives=5, negatives=5, percent=80):
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for i, (anchor, label, v) in enumerate(rows):
        if not asks(anchor):
            continue
        scored = [(-dot(v, w), c, other) for j, (c, other, w) in enumerate(rows) if j != i and len(w) == len(v)]
        chosen = sorted((s, c) for s, c, other in scored if other == label)[:positives]
        for s, positive in chosen:
            p = -s
            window = sorted((n, c) for n, c, other in scored if other != label and percent * p <= -100 * n <= 100 * p)[:negatives]
            out += [(anchor, positive, rank, c, p, -n) for rank, (n, c) in enumerate(window, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def make(n, dims, spread, seed, labels=3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, spread, (labels, dims))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        rows.append((i, label, [int(x) for x in np.floor(middle[label] * rng.uniform(0, 1.2) + rng.normal(0, spread / 2, dims))]))
    return rows


@pytest.mark.parametrize("dims,spread,seed", [(64, 30, 1), (5, 200, 2), (17, 4, 3), (3, 1, 4)])
def test_equals_the_full_scan(spark, dims, spread, seed):
    rows = make(300, dims, spread, seed)
    rows += [(i, 1, rows[0][2]) for i in range(300, 340)]  # ties
    rows += [(7, 2, rows[9][2]), (400, 0, [0] * dims), (401, 1, [0] * dims), (500, 0, [1, 2]), (501, 1, [1, 1]), (503, 0, [1, 2])]
    got = mining.hard_negatives(spark.createDataFrame(rows, ROWS).repartition(3), F.col("vec_id") % 20 == 0, shard_rows=30, query_rows=5)
    want = brute(rows, lambda i: i % 20 == 0)
    assert found(got) == want and want


def test_large_components_stay_exact(spark):
    rows = [(i, i % 2, [x * 3_000_000 + i for x in v]) for i, (_, _, v) in enumerate(make(60, 4, 5, 9))]
    rows += [(100 + i, i % 2, [x * 3_000_000_0 for x in v]) for i, (_, _, v) in enumerate(make(40, 4, 5, 10))]
    assert found(mining.hard_negatives(spark.createDataFrame(rows, ROWS), F.col("vec_id") < 10)) == brute(rows, lambda i: i < 10)


def test_the_index_leaves_dimensions_out():
    rng = np.random.default_rng(5)
    v = np.floor(rng.normal(0, 1, (2000, 64)) * (100 * 0.8 ** np.arange(64))).astype(np.int64)
    index = mining.PartialIndex(v, int(abs(v).max()))
    q, norms = index.prepared(v[:20])
    least = 0.8 * norms[:, 0] ** 2
    pairs = {(i, int(r)): int(s) for i, rows, scores in index.reach(q, norms, least, np.arange(2000), np.full(20, -1)) for r, s in zip(rows, scores)}
    exact = v[:20] @ v.T
    assert pairs == {(i, r): int(exact[i, r]) for i in range(20) for r in range(2000) if exact[i, r] >= least[i]}
    assert 0 < index.listed < 2000 * 8 / 2


def test_odd_rows_and_an_empty_table(spark):
    shape = "vec_id long, embedding array<float>, label int, LABEL2 string, v int"
    rows = [(0, [1.0, 0.5], 1, "", 1), (1, [1.0, None], 1, "", 1), (2, None, 1, "", 1), (3, [], 1, "", 1), (4, [float("nan"), 1.0], 0, "", 1), (5, [float("inf"), 1.0], 0, "", 1)]
    rows += [(6, [1.0, 0.4], 1, "", 1), (8, [0.9, 0.5], 2, "", 1), (9, [-1.0, 0.5], 2, "", 1), (None, [1.0, 0.5], 2, "", 1), (10, [1.0, 0.5], None, "", 1)]
    vectors = integer_vectors(spark.createDataFrame(rows, shape), 256.0, "label").where("vec_id is not null and label is not null")
    assert sorted(r[0] for r in vectors.collect()) == [0, 6, 8, 9]
    got = found(mining.hard_negatives(vectors, F.col("vec_id") == 0))
    assert got == [(0, 6, 1, 8, 256 * 256 + 128 * 102, 230 * 256 + 128 * 128)]
    assert mining.hard_negatives(spark.createDataFrame([], ROWS), F.col("vec_id") == 0).count() == 0
    with pytest.raises(Exception, match="beyond a long"):
        integer_vectors(spark.createDataFrame([(1, [1e30], 1, "", 1)], shape), 256.0).collect()
