from __future__ import annotations

import hashlib
from collections import defaultdict

import pyarrow as pa
import pytest

from cases import awkward, awkward_rows, clashing, empty
from statewatt.llm import exact


def norm(text):
    return (text or "").encode().lower()


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[norm(t)].append(i)
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        stays = False
        for i in ids:
            kept = i == best and not stays
            stays |= kept
            out.append((i, best, len(ids), kept, hashlib.sha256(text).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("memory", [exact.MEMORY_BYTES, 2000])
def test_membership_is_brute_force(spark, memory):
    found = exact.membership(awkward(spark), memory=memory).collect()
    assert sorted(map(tuple, found), key=str) == brute(awkward_rows())


def test_other_columns_do_not_matter(spark):
    found = exact.membership(clashing(awkward(spark))).collect()
    assert sorted(map(tuple, found), key=str) == brute(awkward_rows())


@pytest.mark.parametrize("memory", [exact.MEMORY_BYTES, 2000])
def test_survivors_are_whole_rows(spark, memory):
    docs = clashing(awkward(spark))
    kept = exact.survivors(docs, memory=memory)
    assert kept.columns == docs.columns
    found = [tuple(r)[:5] for r in kept.collect()]
    want = defaultdict(list)
    for r in awkward_rows():
        want[norm(r[1])].append(r)
    assert len(found) == len(want)
    for r in found:
        group = want.pop(norm(r[1]))
        assert r in group
        assert r[0] == max((g[0] for g in group if g[0] is not None), default=None)


def test_empty_table(spark):
    assert exact.membership(empty(spark)).count() == 0
    assert exact.survivors(empty(spark)).count() == 0


def test_grace_spills_and_compares_contents(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    schema = pa.schema([(exact.ID, pa.int64()), (exact.TEXT, pa.string()), (exact.HASH, pa.int64()), (exact.COUNT, pa.int64())])
    texts = [f"text {i % 700} " * 20 for i in range(3000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(at, at + 100)), pa.array(texts[at : at + 100]), pa.array([hash(t) for t in texts[at : at + 100]]), pa.array([1] * 100)], schema=schema) for at in range(0, 3000, 100)]
    merged = pa.Table.from_batches(list(exact.grace(iter(batches), memory=30_000)), schema).to_pylist()
    assert {r[exact.TEXT]: (r[exact.ID], r[exact.COUNT]) for r in merged} == {t: (max(i for i, x in enumerate(texts) if x == t), texts.count(t)) for t in set(texts)}
    assert len(merged) == 700 and not list(tmp_path.iterdir())


def test_equal_hashes_are_not_equal_texts():
    table = exact.OpenTable()
    first = [table.put(7, f"t{i}".encode()) for i in range(3000)]
    assert [e for e, _ in first] == list(range(3000)) and all(new for _, new in first)
    assert table.put(7, b"t1234") == (1234, False)
    wide = exact.OpenTable()
    for i in range(5000):
        wide.put(i * 0x9E3779B97F4A7C15 & (1 << 64) - 1, str(i).encode())
    assert all(wide.put(i * 0x9E3779B97F4A7C15 & (1 << 64) - 1, str(i).encode()) == (i, False) for i in range(5000))
