from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cases import awkward, awkward_rows, clashing, empty
from statewatt.llm import mixing


def sizes(rows):
    return [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _, s, _ in rows]


def water(by_source, weights=(5, 2, 1), readings=3):
    order = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    capped = set()
    while True:
        left = sum(by_source.values()) - sum(readings * by_source[s] for s in capped)
        free = sum(w[s] for s in order if s not in capped)
        level = left / free if free else 0
        more = {s for s in order if s not in capped and readings * by_source[s] <= level * w[s]}
        if not more:
            return {s: readings * by_source[s] if s in capped else level * w[s] for s in order}
        capped |= more


def test_mix_is_brute_force(spark):
    rows = sizes(awkward_rows())
    by = Counter()
    for _, s, n in rows:
        by[s] += n
    target = water(by)
    assert any(target[s] == 3 * by[s] for s in by) and any(target[s] < by[s] for s in by)
    want, ahead = [], defaultdict(int)
    for i, s, n in sorted(rows, key=lambda r: (hashlib.md5(b"" if r[0] is None else str(r[0]).encode()).hexdigest(), r[2])):
        words = int(target[s])
        start, taken = ahead[s], 0
        while start < words and n:
            taken += min(n, words - start)
            start += by[s]
        ahead[s] += n
        want.append((i, s, n, by[s], taken))
    for docs in (awkward(spark), clashing(awkward(spark))):
        found = mixing.mix(docs).collect()
        assert Counter((r["doc_id"], r["source"], r["size"], r["source_size"], r["taken"]) for r in found) == Counter(want)
        assert all(r["target"] == pytest.approx(target[r["source"]]) for r in found)
    taken = Counter()
    for _, s, _, _, t in want:
        taken[s] += t
    assert all(abs(taken[s] - target[s]) <= 1 for s in by)


def test_positions_follow_the_schedule(spark):
    found = mixing.curriculum(mixing.mix(awkward(spark))).collect()
    places = [r["position"] for r in found]
    assert places == sorted(places) and 0 <= min(places) and max(places) <= 1
    by = defaultdict(list)
    for r in found:
        by[r["source"]].append(r)
    for rows in by.values():
        target = rows[0]["target"]
        curve = mixing.COURSES[rows[0]["class"]]
        for t in (0.25, 0.5, 0.75):
            step = 1e-4
            wanted = sum(step * rate(curve, (i + 0.5) * step) for i in range(int(t / step))) / sum(step * rate(curve, (i + 0.5) * step) for i in range(int(1 / step)))
            got = sum(r["words"] for r in rows if r["position"] < t) / target
            assert got == pytest.approx(wanted, abs=max(r["words"] for r in rows) / target + 0.01)


def rate(knots, t):
    for (t0, r0), (t1, r1) in zip(knots, knots[1:]):
        if t0 <= t <= t1:
            return r0 + (r1 - r0) * (t - t0) / (t1 - t0)


def test_inverse_of_the_integral(spark):
    for knots in (*mixing.COURSES, ((0.0, 0.0), (0.3, 2.0), (0.6, 0.0), (1.0, 0.0))):
        shares = spark.range(0, 101).select((F.col("id") / 100.0).alias("y"))
        for y, t in shares.select("y", mixing.time_of(F.col("y"), knots).alias("t")).collect():
            whole = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
            area = 0.0
            for (t0, r0), (t1, r1) in zip(knots, knots[1:]):
                end = min(t, t1)
                if end > t0:
                    area += (end - t0) * (r0 + r0 + (r1 - r0) * (end - t0) / (t1 - t0)) / 2
            assert area / whole == pytest.approx(y, abs=1e-6)
    with pytest.raises(ValueError):
        mixing.time_of(F.lit(0.5), ((0.0, 0.0), (1.0, 0.0)))


def test_reruns_agree_whatever_the_partitions(spark):
    a, b = (sorted(map(str, mixing.mix(awkward(spark).repartition(n)).collect())) for n in (2, 9))
    assert a == b


def test_mixed_documents_come_as_often_as_they_are_read(spark):
    docs = clashing(awkward(spark))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    found = Counter(tuple(r)[:5] for r in mixed.collect())
    want, total = Counter(), Counter(awkward_rows())
    for r in mixing.mix(awkward(spark)).collect():
        whole, part = divmod(r["taken"], r["size"]) if r["size"] else (0, 0)
        want[r["doc_id"], r["source"], r["size"]] += whole + (2 * part >= r["size"] if part else 0)
    got = Counter()
    for row, n in found.items():
        (i, s, size), = sizes([row])
        assert row in total
        got[i, s, size] += n
    assert got == +want


def test_empty_table(spark):
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.curriculum(mixing.mix(empty(spark))).count() == 0
    assert mixing.mixed_documents(empty(spark)).count() == 0
    only = spark.createDataFrame([(1, None, "x"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r["size"], r["taken"]) for r in mixing.mix(only).collect()] == [(0, 0)] * 2
