"""WARC archives with revisits, and their merged capture index.

Pages become WARC 1.1 records, written and read back with Spark's own file
sources, so the archives may live in any store Spark reaches. Each archive file
yields one run of index entries sorted by URL key and time. The entries are
dealt by ranges of (URL key, time, record), and each task merges the runs of
its range with a loser tree; ranges follow each other, so the whole is in
order, and the captures of one URL form its history however many they are.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import pickle
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statewatt.llm.common import cut, pick

#: Records of one archive file; entries a merging task holds before it spills, runs
#: it merges at once and entries of a run it reads at once.
FILE_RECORDS = 2_000
HELD_ENTRIES = 200_000
FAN_IN = 64
RUN_BATCH = 1_000
#: The capture time of page 0; a page follows a second after the one with the id before.
FIRST_CAPTURE = "2024-01-01 00:00:00"
#: What ends a WARC record.
RECORD_END = "\r\n\r\n"

INDEX = "url_key string, captured string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, offset long, length long"
_NAMES = [c.split()[0] for c in INDEX.split(", ")]
_KINDS = [pa.int64() if c.split()[1] == "long" else pa.string() for c in INDEX.split(", ")]


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query, in lower case: captures of a
    site and of its pages sort together."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d+)?([^#]*)", (url or "").strip().lower())
    if not m:
        return (url or "").strip().lower()
    host = re.sub(r"^www\d*\.", "", m[1])
    return f"{','.join(reversed(host.split('.')))}){m[2] or '/'}"


def base32_of_hex(c: Column) -> Column:
    """Base 32 of 40 hexadecimal digits: five digits are four letters."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

    def four(i: Column) -> Column:
        n = F.conv(c.substr(i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        parts = [F.substring(F.lit(letters), F.shiftright(n, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
        return F.concat(*parts)

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), four), "")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """(value): a WARC record per page, without what ends it.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with
    the largest id is a response and the others revisit it; smaller payloads
    are all responses. Rows that share the largest id are all responses. A null
    payload is empty, a null id loses to any other, a null URL is left out.
    """
    few = pick(pages, id_col, url_col, payload_col).toDF("page_id", "url", "html")
    few = few.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    few = few.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html").cast("long"))
    best = cut(few.groupBy("digest", "size").agg(F.max("page_id").alias("best"), F.count("*").alias("rows")).where(F.col("size") >= min_bytes).where("rows > 1").select("digest", "size", "best"))
    told = few.join(best, ["digest", "size"], "left")
    revisit = F.coalesce(~F.col("best").eqNullSafe(F.col("page_id")) & F.col("best").isNotNull(), F.lit(False))
    second = F.pmod(F.coalesce("page_id", F.lit(0).cast("long")), F.lit(1 << 31)).cast("decimal(18,6)")
    day = F.lit(FIRST_CAPTURE).cast("timestamp_ntz") + F.make_dt_interval(secs=second)
    date = F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    length = F.length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("size"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name(F.col("page_id")),
        F.lit("\r\nWARC-Date: "), date,
        F.when(F.col("url").isNull(), F.lit("")).otherwise(F.concat(F.lit("\r\nWARC-Target-URI: "), uri)),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), base32_of_hex(F.col("digest")),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), name(F.col("best")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"), F.lit("\r\n\r\n"),
    )
    return told.select(F.concat(head, block).alias("value"))


def write_archives(rows: DataFrame, folder: str, file_records: int = FILE_RECORDS) -> None:
    """Gzipped WARC files of at most ``file_records`` records."""
    writer = rows.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", file_records)
    writer.text(folder)


def read_records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of a WARC file's records, in order;
    offsets count unpacked bytes."""
    file = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)))
    at = 0
    while first := file.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        size, headers = len(first), {}
        while (line := file.readline()) not in (b"\r\n", b""):
            size += len(line)
            key, _, value = line.decode("utf-8").partition(":")
            headers[key.lower()] = value.strip()
        n = int(headers["content-length"])
        block = file.read(n)
        if len(block) != n or file.read(4) != b"\r\n\r\n":
            raise ValueError(f"broken WARC record at byte {at}")
        size += 2 + n + 4
        yield at, size, headers, block
        at += size


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def index_run(file: str, content: bytes) -> list[tuple]:
    """The sorted index entries of one archive file. A response's payload is
    measured and held against its digest; a revisit's is as its headers say."""
    entries = []
    for offset, length, headers, block in read_records(content):
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = headers["warc-payload-digest"].partition(":")[2]
        size = int(re.search(rb"(?mi)^content-length: (\d+)", http)[1])
        if headers["warc-type"] == "response":
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != size:
                raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
        url = headers.get("warc-target-uri")
        entries.append((url_key(url), headers["warc-date"], _page(headers["warc-record-id"]), url, size, digest, headers["warc-type"], _page(headers.get("warc-refers-to")), file, offset, length))
    return sorted(entries, key=_order)


def _order(e: tuple) -> tuple:
    return e[0], e[1], e[2] is not None, e[2] or 0, e[8], e[9]


class LoserTree:
    """Merges sorted iterators: each inner node keeps the loser of its match, so
    a new entry plays only the matches on its way up."""

    def __init__(self, runs: list[Iterator[tuple]]) -> None:
        self.runs, self.k = runs, max(1, len(runs))
        self.heads = [self._next(i) for i in range(len(runs))] or [None]
        self.tree = [-1] * self.k
        for i in range(self.k):
            self._play(i)

    def _next(self, i: int):
        entry = next(self.runs[i], None)
        return None if entry is None else (_order(entry), entry)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x[0], a) <= (y[0], b))

    def _play(self, i: int) -> None:
        node, winner = (i + self.k) // 2, i
        while node > 0:
            other = self.tree[node]
            if other < 0:  # the first to come waits for its match
                self.tree[node] = winner
                return
            if self._beats(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while (head := self.heads[self.tree[0]]) is not None:
            yield head[1]
            winner = self.tree[0]
            self.heads[winner] = self._next(winner)
            self._play(winner)


def _batch(entries: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*entries), _KINDS)], _NAMES)


def _runs_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            if run := index_run(path.as_py(), content.as_py()):
                yield _batch(run)


class _Scratch:
    """Sorted runs in a scratch file of the task, written and read a batch at a time."""

    def __init__(self, file, batch: int) -> None:
        self.file, self.batch = file, batch

    def write(self, entries: Iterable[tuple]) -> list[int]:
        """The places of the run's batches."""
        places, entries = [], iter(entries)
        while part := list(islice(entries, self.batch)):
            places.append(self.file.seek(0, 2))
            pickle.dump(part, self.file)
        return places

    def read(self, places: list[int]) -> Iterator[tuple]:
        for at in places:
            self.file.seek(at)
            yield from pickle.load(self.file)


def merge_runs(batches: Iterable[pa.RecordBatch], held: int = HELD_ENTRIES, fan_in: int = FAN_IN, batch: int = RUN_BATCH) -> Iterator[pa.RecordBatch]:
    """One task's range in order. Entries are gathered by archive file; beyond
    ``held`` of them the tree merges those at hand into one run on scratch. At the
    end it merges the runs, at most ``fan_in`` at once, of each of which one
    batch is in memory; more runs than that are merged in passes."""
    with tempfile.TemporaryFile() as file:
        scratch, runs = _Scratch(file, batch), []
        memory: dict[str, list[tuple]] = {}
        count = 0

        def at_hand() -> list[Iterator[tuple]]:
            return [iter(sorted(entries, key=_order)) for entries in memory.values()]

        for records in batches:
            for entry in zip(*(c.to_pylist() for c in records.columns)):
                memory.setdefault(entry[8], []).append(entry)
            count += records.num_rows
            if count > held:
                runs.append(scratch.write(LoserTree(at_hand())))
                memory.clear()
                count = 0
        while len(runs) > fan_in:
            runs = runs[fan_in:] + [scratch.write(LoserTree([scratch.read(r) for r in runs[:fan_in]]))]
        out = []
        for entry in LoserTree([scratch.read(r) for r in runs] + at_hand()):
            out.append(entry)
            if len(out) == 10_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)


def capture_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index of all archives in ``folder`` in order of URL key, time and
    page: partitions are ranges, and each is merged from the files' runs."""
    files = spark.read.format("binaryFile").load(folder).where(F.col("length") > 0).select("path", "content")
    runs = cut(files.mapInArrow(_runs_of, INDEX))
    return runs.repartitionByRange("url_key", "captured", "page_id", "file", "offset").mapInArrow(merge_runs, INDEX)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, file_records: int = FILE_RECORDS) -> DataFrame:
    """Writes archives of ``pages`` into a new folder of the session's shared
    checkpoint folder, reads them back and returns their capture index."""
    spark = pages.sparkSession
    rows = records(pages, id_col, url_col, payload_col, min_bytes)
    folder = f"{spark.sparkContext.getCheckpointDir()}/warc-{uuid.uuid4().hex}"
    write_archives(rows, folder, file_records)
    return capture_index(spark, folder)
