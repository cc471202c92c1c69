from __future__ import annotations

import base64
import gzip
import hashlib
import os
import random
import tracemalloc

import pytest

from statewatt.llm import warc

PAGES = "page_id long, url string, html string"


def table():
    rows = [(i, f"https://{'www.' if i % 2 else ''}h{i % 5}.example.org:8080/p{i % 7}?q={i % 3}#x", f"<p>page {i % 60}</p>\r\n\r\nWARC/1.1\r\n\r\n" * (1 + i % 4)) for i in range(300)]
    rows += [(400, "http://h1.example.org/same", "é" * 40_000), (401, "http://h1.example.org/same", None), (402, None, ""), (403, "odd url\r\nWarc-Type: x", "\r\n\r\n"), (404, "", "unique")]
    return rows + [(None, "http://h9.example.org/", "lonely"), (None, "http://h9.example.org/", "unique"), (405, "http://h9.example.org/", "twice"), (405, "http://h9.example.org/", "twice")]


def brute(rows, min_bytes=0):
    best = {}
    for i, _, html in rows:
        best[html or ""] = max(best.get(html or "", -1), -1 if i is None else i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        top = best[html or ""]
        first = len(raw) < min_bytes or top == (-1 if i is None else i)
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if first else "revisit", None if first else top))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes,file_records", [(0, 2000), (0, 7), (30, 2000)])
def test_round_trip(spark, min_bytes, file_records):
    pages = spark.createDataFrame(table(), PAGES).repartition(4)
    wide = pages.selectExpr("*", "1 as digest", "2 as size", "'x' as HTML", "'y' as value")
    found = warc.archive(wide, min_bytes=min_bytes, file_records=file_records).collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found), key=str) == brute(table(), min_bytes)
    order = [(r["url_key"], r["captured"], r["page_id"] is not None, r["page_id"] or 0) for r in found]
    assert order == sorted(order)
    assert all("\n" not in (r["url"] or "") for r in found)


def test_archives_are_warc(spark, tmp_path):
    folder = str(tmp_path / "a")
    warc.write_archives(warc.records(spark.createDataFrame(table(), PAGES)), folder, 50)
    seen = {}
    for name in os.listdir(folder):
        if name.endswith(".gz"):
            content = open(f"{folder}/{name}", "rb").read()
            raw = gzip.decompress(content)
            at = 0
            for offset, length, headers, block in warc.read_records(content):
                assert offset == at and raw[at : at + 8] == b"WARC/1.1" and raw[at + length - 4 : at + length] == b"\r\n\r\n"
                at += length
                if headers["warc-type"] == "response" and headers["warc-record-id"] != "<urn:page:none>":
                    seen[headers["warc-record-id"]] = block.partition(b"\r\n\r\n")[2]
            assert at == len(raw)
    assert seen["<urn:page:400>"].decode() == "é" * 40_000 and seen["<urn:page:403>"] == b"\r\n\r\n"


def test_loser_tree_merges(monkeypatch):
    rng = random.Random(2)
    entries = [(f"k{rng.randrange(40)}", f"t{rng.randrange(9)}", i if i % 9 else None, None, 0, "", "response", None, f"f{i % k}", i, 0) for k in [13] for i in range(700)]
    for k in (0, 1, 2, 3, 8, 13):
        runs = [sorted((e for e in entries if k and int(e[8][1:]) % k == n), key=warc._order) for n in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted((e for r in runs for e in r), key=warc._order)
    batches = [warc._batch([e for e in entries if e[8] == f"f{n}"]) for n in range(13)]
    for held in (10, 10_000):
        merged = [r for b in warc.merge_runs(batches, held) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert merged == sorted(entries, key=warc._order)


def test_broken_archives_are_told():
    with pytest.raises(ValueError):
        list(warc.read_records(gzip.compress(b"nonsense\r\n")))


def test_url_keys():
    assert warc.url_key("HTTPS://user@WWW.A.example.org:81/X?q=1#f") == "org,example,a)/x?q=1"
    assert warc.url_key(None) == "" and warc.url_key("http://a.org") == "org,a)/"


def test_empty_table(spark):
    assert warc.archive(spark.createDataFrame([], PAGES)).count() == 0


def test_the_merge_holds_few_entries():
    """Peak memory follows what may be held, not the range; passes keep the order."""

    def batches(n):
        for k in range(n // 500):
            rows = [(f"org,h{(k * 7919 + j * 31) % 997})/", f"t{j:05d}", k * 500 + j, "http://h.org/" + "x" * 100, 1, "d" * 32, "response", None, f"f{k % 40}", j, 1) for j in range(500)]
            yield warc._batch(rows)

    peaks = []
    for n in (20_000, 80_000):
        tracemalloc.start()
        last, count = None, 0
        for b in warc.merge_runs(batches(n), held=4_000, fan_in=4, batch=100):
            for entry in zip(*(c.to_pylist() for c in b.columns)):
                key = warc._order(entry)
                assert last is None or last <= key
                last, count = key, count + 1
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert count == n
    assert peaks[1] < 1.3 * peaks[0]
