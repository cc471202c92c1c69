from __future__ import annotations

import hashlib

import numpy as np
import pytest

from statewatt.llm import zones

ROWS = "vec_id long, v array<long>"


def brute(rows, k=8, rounds=10, seed="3"):
    named = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [list(v) for _, v in named[:k]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c)), i) for i, c in enumerate(centroids)) for _, v in rows]

    for _ in range(rounds):
        own = assign()
        for i in range(len(centroids)):
            members = [v for (_, v), (_, c) in zip(rows, own) if c == i]
            if members:
                centroids[i] = [sum(x) // len(members) for x in zip(*members)]
    own = assign()
    sums = [sum(d for d, c in own if c == i) for i in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((-1 if i is None else i), c, d, sums[c], sum(sums), names[c]) for (i, _), (d, c) in zip(rows, own))


def found(df):
    return sorted((-1 if r[0] is None else r[0], *tuple(r)[1:]) for r in df.collect())


def make(n, dims, spread, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 4 * spread, (6, dims))
    return [(i, [int(x) for x in np.floor(middle[rng.integers(6)] + rng.normal(0, spread, dims))]) for i in range(n)]


@pytest.mark.parametrize("dims,spread,seed", [(64, 300, 1), (2, 3, 2), (1, 1, 3)])
def test_equals_plain_k_means(spark, dims, spread, seed):
    rows = make(400, dims, spread, seed)
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(3, rows[5][1]), (None, rows[7][1]), (None, rows[7][1])]
    for block_rows in (512, 16):
        assert found(zones.clusters(spark.createDataFrame(rows, ROWS).repartition(5), block_rows=block_rows)) == brute(rows)


def test_components_beyond_safe_products(spark):
    rows = [(i, [x + 10**15 for x in v]) for i, v in make(60, 64, 20_000, 4)]
    assert found(zones.clusters(spark.createDataFrame(rows, ROWS))) == brute(rows)
    with pytest.raises(Exception):
        zones.clusters(spark.createDataFrame([(i, [(-1) ** i * 2**61] * 64) for i in range(20)], ROWS)).collect()


def test_few_rows_and_none(spark):
    rows = [(1, [1, 2]), (2, [5, 5]), (2, [5, 5])]
    assert found(zones.clusters(spark.createDataFrame(rows, ROWS))) == brute(rows)
    empty = zones.clusters(spark.createDataFrame([], ROWS))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_the_curve_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = zones.hilbert_keys(cells, bits)
        assert len(set(keys)) == side**dims
        walk = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert (abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_no_nearest_centroid_is_pruned():
    rng = np.random.default_rng(6)
    pruned = 0
    for _ in range(200):
        low = rng.integers(-50, 50, 6)
        high = low + rng.integers(0, 30, 6)
        centroids = rng.integers(-60, 80, (9, 6))
        few = set(zones.candidates(low, high, centroids).tolist())
        pruned += 9 - len(few)
        points = np.r_[rng.integers(low, high + 1, (300, 6)), low[None], high[None]]
        assert set(((points[:, None] - centroids) ** 2).sum(2).argmin(1).tolist()) <= few
    assert pruned > 200


def test_blocks_lie_in_order_and_carry_their_zones(spark):
    blocks = zones.zone_blocks(spark.createDataFrame(make(500, 3, 20, 8), ROWS).repartition(4), block_rows=32).collect()
    assert len(blocks) == 500 and {r["low"] is None for r in blocks} == {True, False}
    at = [i for i, r in enumerate(blocks) if r["low"] is not None]
    for a, b in zip(at, [*at[1:], len(blocks)]):
        v = np.array([r["v"] for r in blocks[a:b]])
        assert b - a <= 32 and blocks[a]["low"] == v.min(0).tolist() and blocks[a]["high"] == v.max(0).tolist()
