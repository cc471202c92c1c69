from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from cases import awkward, awkward_rows, clashing, empty
from statewatt.llm import components, simhash


def brute_fp(text, width=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w)] if len(w) < width else [b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(codes, k):
    codes, parent = list(codes), {c: c for c in codes}

    def find(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[:i]:
            if (a ^ b).bit_count() <= k:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {c: find(c) for c in codes}


def brute(rows, k=3):
    fps = [(r[0], brute_fp(r[1])) for r in rows]
    roots = brute_roots({f for _, f in fps}, k)
    least = {}
    for i, f in fps:
        least.setdefault(roots[f], []).append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in least.items()}
    return sorted(((i, f"{f:016x}", least[roots[f]]) for i, f in fps), key=str)


def clustered(n, seed=5):
    """Codes in chains and balls, so components reach further than k."""
    rng, out = random.Random(seed), set()
    while len(out) < n:
        c = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 40, 150])):
            out.add(c)
            for _ in range(rng.randrange(1, 5)):
                c ^= 1 << rng.randrange(64)
    return sorted(out)


def test_hash_is_spark_s_too(spark):
    from pyspark.sql import functions as F

    text = "Ünï code w1"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] & (1 << 64) - 1 == xxhash.xxh64_intdigest(text.encode(), 42)


def test_near_duplicates_are_brute_force(spark):
    want = brute(awkward_rows())
    assert any(c is not None and i != c for i, _, c in want)
    assert sorted(map(tuple, simhash.near_duplicates(awkward(spark)).collect()), key=str) == want
    assert sorted(map(tuple, simhash.near_duplicates(clashing(awkward(spark)), cell_rows=4).collect()), key=str) == want


@pytest.mark.parametrize("k,cell_rows", [(3, 2048), (3, 20), (0, 2048), (2, 50)])
def test_no_link_is_lost(spark, k, cell_rows):
    codes = clustered(900)
    df = spark.createDataFrame([(int(np.uint64(c).astype(np.int64)),) for c in codes], "fp long").repartition(7)
    links = simhash.near_links(df, k, cell_rows)
    found = {r["node"]: r["root"] for r in components.components(links, "a", "b").collect()}
    signed = {c: int(np.uint64(c).astype(np.int64)) for c in codes}
    want = brute_roots(codes, k)
    groups, mine = {}, {}
    for c in codes:
        groups.setdefault(want[c], set()).add(signed[c])
        mine.setdefault(found.get(signed[c], signed[c]), set()).add(signed[c])
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))
    assert len(groups) > 5


def test_index_sorts_by_gray_rank_and_masks_shared_bits():
    gray = np.array([i ^ i >> 1 for i in range(1000)], np.uint64)
    assert (simhash.gray_rank(gray) == np.arange(1000)).all()
    index = simhash.GrayIndex(np.zeros(1000, np.int64), gray)
    _, bits, mask, below = index.levels[1]
    for i in range(len(bits)):
        own = gray[below[i] : below[i + 1]]
        assert ((own & mask[i]) == bits[i]).all()
        assert (np.bitwise_or.reduce(own ^ own[0]) & mask[i]) == 0


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(7, 7), (1000, 1001), (1001, 1000), (None, 5)], "a long, b long")
    found = {r["node"]: r["root"] for r in components.components(edges, "a", "b").collect()}
    assert found == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def test_representatives(spark):
    docs = clashing(awkward(spark))
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    found = [tuple(r)[:5] for r in kept.collect()]
    assert set(found) <= set(awkward_rows())
    roots = brute_roots({brute_fp(r[1]) for r in awkward_rows()}, 3)
    least = {}
    for r in awkward_rows():
        least.setdefault(roots[brute_fp(r[1])], []).append(r[0])
    assert sorted((roots[brute_fp(r[1])], r[0]) for r in found if r[0] is not None) == sorted((c, min(i for i in ids if i is not None)) for c, ids in least.items() if any(i is not None for i in ids))
    assert len(found) == len(least)


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.representatives(empty(spark)).count() == 0
