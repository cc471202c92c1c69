"""Repeated passages, by hashed units of text and by hashed stretches of words.

A unit is a sentence or a line. Units are normalised and digested, digests are
grouped over all documents, the earliest occurrence by (doc_id, place) stays
and the others go, as runs of adjacent units with offsets into the original
text. A run has to hold a least number of words, so a document is not touched
for a stray short sentence. A unit under ``UNIT_WORDS`` words tells nothing by
itself: it is digested with the unit before it, and with the one before that if
that is short too. So "No!" behind a repeated sentence goes only where "No!"
stood behind that sentence, and a list of common words is no passage.

Units miss a passage that begins and ends inside sentences. So every stretch of
``STRETCH`` white-space separated words that stands word for word, case aside,
at an earlier place goes too. Each such window is known by the least hash of
its ``ANCHOR``-word runs; adjacent windows of one least hash are a segment, and
equal windows have equal ones. Only segments whose hash repeats are compared:
first as wholes, then, where segments of one hash differ, window by window.

Adjacent units that may repeat move as one block. A block that stands at an
earlier place goes as a whole; only the first of each kind is opened into units.

Texts never move. They are read once to count 64 bits of each digest; what may
repeat is noted in a table of bits of fixed size, so that the second time little
more than the repeated units and segments move. Which segments have to be opened
is noted in such a table as well, and their texts are read where they lie.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewatt.llm.common import pick
from statewatt.session import stored

#: Words a removed run of units holds at least.
MIN_WORDS = 25
#: Words of a unit that is told by itself.
UNIT_WORDS = 3
#: Words of a stretch that goes wherever it begins, and of the runs it is known
#: by; ``_hashes`` is written for these two.
STRETCH, ANCHOR = 50, 16
WINDOWS = STRETCH - ANCHOR + 1
#: Bits of the table that tells which digests may repeat: 32 MB whatever the input.
#: Full, it lets all rows pass, so it decides what moves, never what is found.
TABLE_BITS = 28
#: Characters that are written without spaces count as a word each, and their
#: sentences end without one.
_SOLID = "\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"
_WORD = re.compile(rf"[{_SOLID}]|[^\W{_SOLID}]+")
#: Characters of texts that are cut together; a longer text is cut by itself.
CHUNK = 1 << 18

#: A unit whose hash ends in that many zero bits ends a block of units, and so does
#: the ``BLOCK``-th; blocks decide how many rows move, never what is found.
BLOCK_BITS, BLOCK = 4, 64
_UNIT = T.StructType([T.StructField(c, T.IntegerType()) for c in ("start", "end", "before", "after")] + [T.StructField("digest", T.BinaryType())])

#: Classes of characters, as bits.
_LETTER, _ALONE, _SPACE, _STOP, _WIDE_STOP = 1, 2, 4, 8, 16
_TABLES: list[np.ndarray] = []


def _classes(points: np.ndarray) -> np.ndarray:
    if not _TABLES:
        table = np.array([(_LETTER if chr(c).isalnum() or c == 95 else 0) | (_SPACE if chr(c).isspace() else 0) for c in range(0x110000)], np.uint8)
        for a, b in re.findall("(.)-(.)", _SOLID):
            table[ord(a) : ord(b) + 1] = _ALONE
        for stops, bit in ((".!?", _STOP), ("\u3002\uff01\uff1f", _WIDE_STOP)):
            table[[ord(c) for c in stops]] |= bit
        _TABLES.append(table)
    return _TABLES[0][points]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [np.cumprod(np.full(64, _BASE, np.uint64))]


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run of ``values``; no run is empty."""
    if not len(starts):
        return np.empty(0, np.uint64)
    sizes = ends - starts
    if (longest := int(sizes.max())) > len(_POWERS[0]):
        _POWERS[0] = np.cumprod(np.full(2 * longest, _BASE, np.uint64))
    first = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum()))
    return _mix(np.add.reduceat(values[at + np.repeat(starts - first, sizes)] * _POWERS[0][at - np.repeat(first, sizes)], first))


def _window_hashes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window of ``STRETCH`` words: the least hash of its runs, its own hash."""
    run = words
    for n in (1, 2, 4, 8):
        run = _mix(run[:-n] * _BASE + run[n:])
    least = run
    for n in (1, 2, 4, 8, 16):
        least = np.minimum(least[:-n], least[n:])
    least = np.minimum(least[: -(WINDOWS - 32)], least[WINDOWS - 32 :])
    both = _mix(run[:-16] * _BASE + run[16:])
    return least, _mix(both[: -(STRETCH - 32)] * _BASE + both[STRETCH - 32 :])


class _Texts:
    """The units and the segments of several texts, cut as one array of characters.

    A unit ends at a full stop, question or exclamation mark before white space,
    at a wide one anywhere, or at a line end. Its hash is of its words alone,
    lower-cased; of a unit without words, of its characters; a short one's is also
    of the units before it. White space alone is no unit, so a run goes on across empty lines, and at any other unit that does
    not repeat, however short, it ends.

    ``unit`` and ``segment`` have a row each of text, number in the text, start
    and end in the array; ``hashes`` 64 bits of each one's digest, units first.
    """

    def __init__(self, texts: list[str]) -> None:
        sizes = np.array([len(t) + 1 for t in texts])
        self.offsets = np.cumsum(sizes) - sizes
        # one code point for each, so that offsets hold: only this letter grows when lower-cased
        self.low = "\n".join(texts).replace("\u0130", "i").lower()
        points = np.frombuffer(self.low.encode("utf-32-le", "surrogatepass"), "<u4")
        kinds = _classes(points)
        letter, solid = kinds & _LETTER > 0, kinds & _SPACE == 0
        joined = letter[1:] & letter[:-1]
        inside = kinds & (_LETTER | _ALONE) > 0
        begins, closes = inside.copy(), inside.copy()
        begins[1:] &= ~joined
        closes[:-1] &= ~joined
        self.before = np.r_[0, np.cumsum(begins)]
        values = points.astype(np.uint64) + np.uint64(1)
        self._units(points, kinds, solid, values, _spans(values, np.flatnonzero(begins), np.flatnonzero(closes) + 1))
        edges = np.flatnonzero(np.diff(np.r_[False, solid, False].astype(np.int8)))
        self.starts, self.ends = edges[::2], edges[1::2]
        self._segments(_spans(values, self.starts, self.ends))
        self.hashes = np.r_[self.unit_hashes, self.least[self.a]].view(np.int64)

    def _numbered(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of ordered places: the text of each and its number there."""
        text = np.searchsorted(self.offsets, starts, "right") - 1
        return text, np.arange(len(text)) - np.searchsorted(text, text)

    def _units(self, points: np.ndarray, kinds: np.ndarray, solid: np.ndarray, values: np.ndarray, words: np.ndarray) -> None:
        size = len(points)
        line, wide = points == 10, kinds & _WIDE_STOP > 0
        cuts = np.zeros(size + 1, bool)
        cuts[1:size] = (kinds[:-1] & _STOP > 0) & ~solid[1:] | wide[:-1] & ~wide[1:]
        cuts[:size] |= line
        cuts[1:] |= line
        cuts[0], cuts[size] = False, True
        ends = np.flatnonzero(cuts)
        starts = np.r_[0, ends[:-1]]
        places = np.flatnonzero(solid)
        first, behind = np.searchsorted(places, starts), np.searchsorted(places, ends)
        real = first < behind
        starts, ends, self.solid_ends = places[first[real]], ends[real], places[behind[real] - 1] + 1
        a, b = self.before[starts], self.before[ends]
        hashes, some = np.empty(len(starts), np.uint64), a < b
        hashes[some] = _spans(words, a[some], b[some])
        hashes[~some] = _mix(~_spans(values, starts[~some], self.solid_ends[~some]))
        text, n = self._numbered(starts)
        self.unit = np.stack([text, n, starts, ends])
        # how many units before it a unit is told by
        short = b - a < UNIT_WORDS
        self.context = np.where(short, np.minimum(n, 1 + np.r_[0, short[:-1]]), 0)
        self.unit_hashes = np.where(short, _mix(hashes + _BASE), hashes)
        for k in (1, 2):
            more = np.flatnonzero(self.context >= k)
            self.unit_hashes[more] = _mix(self.unit_hashes[more] * _BASE + hashes[more - k])

    def _segments(self, words: np.ndarray) -> None:
        """``a`` and ``b`` are first windows and those behind the last, at most
        ``WINDOWS`` apart; ``least`` and ``grams`` the hashes of all windows."""
        if len(words) < STRETCH:
            self.a = self.b = self.window = np.empty(0, np.int64)
            self.least = self.grams = np.empty(0, np.uint64)
        else:
            text, number = self._numbered(self.starts)
            self.window = np.flatnonzero(text[: len(text) - STRETCH + 1] == text[STRETCH - 1 :])
            self.least, self.grams = (h[self.window] for h in _window_hashes(words))
            text, at = text[self.window], np.arange(len(self.window))
            new = np.r_[True, (self.least[1:] != self.least[:-1]) | (text[1:] != text[:-1])][: len(at)]
            self.a = np.flatnonzero((at - np.maximum.accumulate(np.where(new, at, 0))) % WINDOWS == 0)
            self.b = np.r_[self.a[1:], len(at)][: len(self.a)]
            self.text, self.number = text, number
        self.segment = self.extents(self.a, self.b)

    def extents(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Text, number of the first word, start and end of windows a to b."""
        if not len(a):
            return np.empty((4, 0), np.int64)
        first, last = self.window[a], self.window[b - 1] + STRETCH - 1
        return np.stack([self.text[a], self.number[first], self.starts[first], self.ends[last]])

    def blocks(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Adjacent ones of ``units`` as blocks, which end by what the units hold, so
        that texts which share a run share its blocks: first units and those behind the last."""
        at = np.arange(len(units))
        cut = (self.unit_hashes[units] & np.uint64((1 << BLOCK_BITS) - 1)) == 0
        new = np.r_[True, (units[1:] != units[:-1] + 1) | (self.unit[0, units[1:]] != self.unit[0, units[:-1]]) | cut[:-1]][: len(at)]
        a = np.flatnonzero((at - np.maximum.accumulate(np.where(new, at, 0))) % BLOCK == 0)
        return a, np.r_[a[1:], len(at)][: len(a)]

    def wholes(self, segments: np.ndarray) -> list[bytes]:
        """What tells all words of a segment: its first and last window and their distance."""
        a, b = self.a[segments], self.b[segments]
        return _bytes(np.stack([self.grams[a], _mix(self.grams[b - 1] + (b - a).astype(np.uint64) * _BASE)], axis=1), 16)

    def rows(self, found: np.ndarray) -> np.ndarray:
        """n, start, end, words before the start and before the end, within the text."""
        text, n, start, end = found
        offset = self.offsets[text]
        return np.stack([n, start - offset, end - offset, self.before[start] - self.before[offset], self.before[end] - self.before[offset]])

    def plain(self, unit: int) -> str:
        """The normalised unit, behind those that it is told by."""
        parts = []
        for k in range(unit - int(self.context[unit]), unit + 1):
            a, b = int(self.unit[2, k]), int(self.solid_ends[k])
            parts.append(" ".join(_WORD.findall(self.low, a, b)) or "\0" + self.low[a:b])
        return "\1".join(parts)

    def digest(self, unit: int) -> bytes:
        own = self.plain(unit)
        return hashlib.blake2b(own.encode("utf-8", "replace"), digest_size=16).digest()


def _bytes(rows: np.ndarray, size: int) -> list[bytes]:
    raw = np.ascontiguousarray(rows).tobytes()
    return [raw[k : k + size] for k in range(0, len(raw), size)]


def _chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[list[int], _Texts]]:
    """Places of non-empty texts and the texts, up to ``limit`` characters at a time."""
    places: list[int] = []
    held: list[str] = []
    size = 0
    for i, t in enumerate(column):
        if text := t.as_py():
            if held and size + len(text) > limit:
                yield places, _Texts(held)
                places, held, size = [], [], 0
            places.append(i)
            held.append(text)
            size += len(text)
    if held:
        yield places, _Texts(held)


def _hashes_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in _chunks(batch.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(texts.hashes)], ["hash"])


def _bits(hashes: DataFrame) -> bytes:
    """A bit for each value of the last ``TABLE_BITS`` bits of a long: whether some
    row of the one column has them. Compressed, so that few rows send little."""
    place = hashes[hashes.columns[0]].bitwiseAND(F.lit((1 << TABLE_BITS) - 1))
    parts = hashes.groupBy(F.shiftright(place, 15).alias("part")).agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    out = np.zeros((1 << TABLE_BITS) // 8, np.uint8)
    for r in parts.toLocalIterator():  # at most 2 ** (TABLE_BITS - 15) rows of 4 KB
        out[r["part"] << 12 : (r["part"] + 1) << 12] = np.frombuffer(r["bits"], np.uint8)
    return zlib.compress(out, 1)


def _table(bits: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(bits), np.uint8)


def _noted(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.int64(8 * len(bits) - 1)
    return bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 > 0


def _spot(key: Column | np.ndarray, n: Column | np.ndarray) -> Column | np.ndarray:
    """64 bits for the n-th thing of a text, alike in Spark and numpy."""
    return key.bitwiseXOR(F.shiftleft(n.cast("long"), 5)) if isinstance(key, Column) else key ^ n.astype(np.int64) << 5


def _listed(rows: DataFrame, *columns: str, hashes: DataFrame) -> DataFrame:
    """``rows`` whose hash, of one column or the spot of two, is one of ``hashes``; a few others pass."""
    bits = rows.sparkSession.sparkContext.broadcast(_bits(hashes))

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(bits.value)
        for batch in batches:
            values = [batch.column(c).to_numpy() for c in columns]
            yield batch.filter(pa.array(_noted(table, values[0] if len(values) == 1 else _spot(*values))))

    return rows.mapInArrow(keep, rows.schema)


def _explode(batches: Iterable[pa.RecordBatch], bits: bytes) -> Iterator[pa.RecordBatch]:
    """Blocks of units and segments of windows of (doc_id, key, text), those whose
    digest may repeat. ``n`` counts units or is the first word's number, ``m`` is how
    many units or windows there are; ``whole`` tells all words of a segment, ``units``
    holds what a block is made of."""
    names = ["doc_id", "key", "n", "start", "end", "before", "after", "m", "digest", "whole", "units"]
    table = _table(bits)
    for batch in batches:
        for places, texts in _chunks(batch.column(2)):
            again = _noted(table, texts.hashes)
            unit = np.flatnonzero(again[: texts.unit.shape[1]])
            segment = np.flatnonzero(again[texts.unit.shape[1] :])
            a, b = texts.blocks(unit)
            digests = [texts.digest(k) for k in unit.tolist()]
            blocks = np.stack([*texts.unit[:3, unit[a]], texts.unit[3, unit[b - 1]]])
            found = np.concatenate([blocks, texts.segment[:, segment]], axis=1)
            at = pa.array(np.array(places, np.int64)[found[0]], pa.int64())
            columns = [c.take(at) for c in batch.columns[:2]] + [pa.array(c, pa.int32()) for c in texts.rows(found).astype(np.int32)]
            columns.append(pa.array(np.r_[b - a, texts.b[segment] - texts.a[segment]], pa.int32()))
            own = [hashlib.blake2b(b"".join(digests[i:j]), digest_size=16).digest() for i, j in zip(a.tolist(), b.tolist())]
            columns.append(pa.array(own + _bytes(texts.least[texts.a[segment]], 8), pa.binary()))
            columns.append(pa.array([None] * len(a) + texts.wholes(segment), pa.binary()))
            parts = [pa.array(c, pa.int32()) for c in texts.rows(texts.unit[:, unit])[1:].astype(np.int32)]
            parts = pa.StructArray.from_arrays([*parts, pa.array(digests, pa.binary())], [f.name for f in _UNIT])
            columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, b, np.full(len(segment), len(unit))], pa.int32()), parts))
            yield pa.RecordBatch.from_arrays(columns, names)


def _windows(batches: Iterable[pa.RecordBatch], bits: bytes) -> Iterator[pa.RecordBatch]:
    """Every window of the noted segments of (doc_id, key, text)."""
    names = ["doc_id", "key", "n", "m", "start", "end", "before", "after", "least", "gram"]
    table = _table(bits)
    for batch in batches:
        keys = batch.column(1).to_numpy()
        for row in np.flatnonzero(_noted(table, keys)).tolist():
            if not (text := batch.column(2)[row].as_py()):
                continue
            texts = _Texts([text])
            listed = np.flatnonzero(_noted(table, _spot(keys[row], texts.segment[1])))
            sizes = texts.b[listed] - texts.a[listed]
            at = np.arange(int(sizes.sum())) + np.repeat(texts.a[listed] - np.cumsum(sizes) + sizes, sizes)
            alike = pa.array(np.full(len(at), row))
            columns = [c.take(alike) for c in batch.columns[:2]]
            columns += [pa.array(np.repeat(c, sizes), pa.int32()) for c in (texts.segment[1, listed], sizes)]
            columns += [pa.array(c, pa.int32()) for c in texts.rows(texts.extents(at, at + 1))[1:].astype(np.int32)]
            columns += [pa.array(h[at].view(np.int64)) for h in (texts.least, texts.grams)]
            yield pa.RecordBatch.from_arrays(columns, names)


def _later(rows: DataFrame, *others: str) -> DataFrame:
    """Extents of ``rows`` that stand behind the ``first`` of their kind. One that
    overlaps it, in a text that repeats itself, begins where it ends."""
    f = F.col("first")
    own = F.col("doc_id").eqNullSafe(f["doc_id"]) & (F.col("key") == f["key"])
    gone = rows.where(~own | (F.col("start") != f["start"]))
    for name, end in (("start", "end"), ("before", "after")):
        gone = gone.withColumn(name, F.when(own, F.greatest(name, f[end])).otherwise(F.col(name)))
    return gone.where("start < end").select("doc_id", "key", "start", "end", "before", "after", "kept", *others)


def _known(kinds: DataFrame, later: DataFrame, part: str) -> DataFrame:
    """``kinds`` of which there are several, with the documents that keep them: those
    that keep the ``later`` parts of the ``first``, and its own unless all parts go."""
    per = later.groupBy(*[F.col(c).alias("_" + c) for c in ("doc_id", "key", "n")]).agg(F.collect_set("kept").alias("others"), F.size(F.collect_set(part)).alias("parts"))
    first = F.col("first")
    joined = kinds.where("size > 1").join(per, first["doc_id"].eqNullSafe(F.col("_doc_id")) & (first["key"] == F.col("_key")) & (first["n"] == F.col("_n")), "left")
    own, others = F.array(first["doc_id"]), F.col("others")
    return joined.withColumn("kept", F.when(others.isNull(), own).when(F.col("parts") < first["m"], F.concat(others, own)).otherwise(others)).drop("others", "parts", "_doc_id", "_key", "_n")


def _stretches(few: DataFrame, segments: DataFrame) -> DataFrame:
    """Extents of repeated windows, from segments whose least hash may repeat. Equal
    segments have the windows of their first, so only firsts are opened, and of their
    windows only those that may repeat move."""
    place = [F.col("doc_id").isNull().alias("none"), *(F.col(c) for c in ("doc_id", "key", "start", "end", "after"))]
    wholes = stored(segments.groupBy("digest", "whole").agg(F.min(F.struct(*place, "n", "m")).alias("first"), F.count("*").alias("size")))
    mixed = wholes.groupBy("digest").count().where("count > 1").select("digest")
    listed = wholes.join(mixed, "digest", "left_semi").select("first.key", "first.n")
    noted = listed.select(F.explode(F.array("key", _spot(F.col("key"), F.col("n")))).alias("hash"))
    bits = few.sparkSession.sparkContext.broadcast(_bits(noted))
    numbers = [T.StructField(c, T.IntegerType()) for c in ("n", "m", "start", "end", "before", "after")]
    schema = T.StructType([*few.schema.fields[:2], *numbers, T.StructField("least", T.LongType()), T.StructField("gram", T.LongType())])
    grams = stored(few.mapInArrow(lambda batches: _windows(batches, bits.value), schema))
    twice = _listed(grams, "gram", hashes=grams.groupBy("gram").count().where("count > 1").select("gram"))
    first = twice.groupBy("least", "gram").agg(F.min(F.struct(*place)).alias("first"), F.count("*").alias("size")).where("size > 1").drop("size")
    later = twice.join(first, ["least", "gram"]).withColumn("kept", F.col("first.doc_id"))
    later = stored(_later(later, "n"))
    known = _known(wholes, later, "end")
    return _later(segments.join(known.select("digest", "whole", "first", "kept"), ["digest", "whole"])).unionAll(later.drop("n").withColumn("kept", F.array("kept")))


def _units(rows: DataFrame, min_words: int) -> DataFrame:
    """Extents of runs of repeated units, from blocks of units that may repeat.

    A block that stands at an earlier place goes as a whole. The first of each kind
    is opened: the first of every unit lies in one, since an earlier block of the
    same kind would hold it earlier.
    """
    place = F.struct(F.col("doc_id").isNull().alias("none"), *(F.col(c).alias(c) for c in ("doc_id", "key", "start")))
    kinds = stored(rows.groupBy("digest").agg(F.min(F.struct(place.alias("place"), "doc_id", "key", "n", "m")).alias("first"), F.count("*").alias("size")))
    spots = kinds.select(_spot(F.col("first.key"), F.col("first.n")).alias("hash"))
    opened = _listed(rows.select("doc_id", "key", "n", "units"), "key", "n", hashes=spots)
    opened = opened.select("doc_id", "key", "n", F.posexplode("units").alias("at", "unit")).select("doc_id", "key", "n", "at", "unit.*")
    first = opened.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("size")).where("size > 1").drop("size")
    later = opened.join(first, "digest").where(place != F.col("first")).withColumn("kept", F.col("first.doc_id"))
    later = stored(later.select("doc_id", "key", "n", "at", "start", "end", "before", "after", "kept"))
    known = _known(kinds, later, "at").select("digest", "first", "kept")
    extent = ["doc_id", "key", "start", "end", "before", "after"]
    whole = rows.drop("units").join(known, "digest").where(place != F.col("first.place"))
    whole = whole.select(*extent, "n", (F.col("n") + F.col("m") - 1).alias("last"), "kept")
    number = F.col("n") + F.col("at")
    gone = whole.unionAll(later.select(*extent, number.alias("n"), number.alias("last"), F.array("kept").alias("kept")))
    order = Window.partitionBy("doc_id", "key").orderBy("n", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = gone.withColumn("new", (F.coalesce(reach, F.lit(-2)) + 1 < F.col("n")).cast("long"))
    runs = runs.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    found = runs.groupBy("doc_id", "key", "run").agg(
        *(F.min(c).alias(c) if c in ("start", "before") else F.max(c).alias(c) for c in extent[2:]), F.flatten(F.collect_set("kept")).alias("kept")
    )
    return found.where(F.col("after") - F.col("before") >= min_words).drop("run")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per removed run: doc_id, start, end (code points of the original
    text, end exclusive), words, kept_doc_id and kept_doc_ids (documents that
    hold the occurrences which stay).

    What goes are runs of repeated units of ``min_words`` words or more, and all
    stretches of ``STRETCH`` white-space separated words or more that stand at
    an earlier place; where these overlap they are one run.

    Documents are ranked by id, a null id last; rows with one id and one text
    are one document. Null and empty texts have no units. A unit that stands nowhere
    before is never part of a run of units, whatever its length. Ties cannot be: the
    place in the text ranks units of one document, so of a passage that repeats
    inside a document the first stays.
    """
    few = pick(docs, id_col, text_col).toDF("doc_id", "text")
    few = few.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    numbers = [T.StructField(c, T.IntegerType()) for c in ("n", "start", "end", "before", "after", "m")]
    rest = [T.StructField("digest", T.BinaryType()), T.StructField("whole", T.BinaryType()), T.StructField("units", T.ArrayType(_UNIT))]
    schema = T.StructType([*few.schema.fields[:2], *numbers, *rest])
    counts = few.select("text").mapInArrow(_hashes_of, "hash long").groupBy("hash").agg(F.count("*").alias("n"))
    bits = few.sparkSession.sparkContext.broadcast(_bits(counts.where("n > 1").select("hash")))
    rows = stored(few.mapInArrow(lambda batches: _explode(batches, bits.value), schema))
    found = _units(rows.where(F.col("whole").isNull()).drop("whole"), min_words)
    found = found.unionByName(_stretches(few, rows.where(F.col("whole").isNotNull()).drop("units")))
    return _united(found)


def _united(found: DataFrame) -> DataFrame:
    """Overlapping extents of one text as one run."""
    order = Window.partitionBy("doc_id", "key").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = found.withColumn("new", (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("long")).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    kept = F.array_sort(F.array_compact(F.array_distinct(F.flatten(F.collect_set("kept")))))
    found = runs.groupBy("doc_id", "key", "run").agg(
        F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end"), (F.max("after") - F.min("before")).cast("long").alias("words"), kept.alias("kept_doc_ids")
    )
    return found.select("doc_id", "start", "end", "words", F.array_min("kept_doc_ids").alias("kept_doc_id"), "kept_doc_ids")


def without_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the passages of ``repeated_passages`` cut out;
    ids must be unique and not null."""
    spans = passages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    joined = pick(docs, "doc_id", "text").join(spans, "doc_id", "left")
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["end"]))
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.length("text").cast("long")))
    parts = F.transform(F.arrays_zip(begins.alias("a"), ends.alias("b")), lambda p: F.substring(F.col("text"), (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")))
    return joined.select("doc_id", F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.array_join(parts, "")).alias("text"))
