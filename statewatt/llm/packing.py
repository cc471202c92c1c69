"""Cost-balanced packing of documents into training sequences.

A document of n tokens costs a linear share of n plus a quadratic share of n²
(attention stays inside a document). A task tokenises its rows and packs them a
window at a time: documents in descending cost, each to the cheapest sequence
that has room for it; when none has, the cheapest with any room takes what
fits. Whole-length pieces of long documents are sequences of their own. What
remains of a window moves to the next; the end of a task fills sequences of
falling powers of two, which need no padding. Nothing is shuffled, and no task
holds more than a window and one document.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from statewatt.llm.common import pick

LENGTH = 4096
END = 2
#: Tokens a window gathers before it is packed, bytes of text tokenised at once.
WINDOW = 1024 * LENGTH
SLICE_BYTES = 6 << 20
#: Chunks whose ids a Python worker remembers, from task to task; beyond that
#: it keeps those of the slice at hand.
REMEMBERED = 800_000
#: Letters below this code point have a lower case of one letter and no other normal
#: form, but for the dotted capital I.
LATIN, LAST_LATIN, DOTTED = 0x180, "\u0180", "\u0130"
#: Cost of a token by itself, and of a token against another of its document.
LINEAR, QUADRATIC = 1.0, 1.0 / LENGTH


class WordTokenizer:
    """Ids of texts by a tokenizer that drops white space and never merges
    across it, so each white-space separated chunk is encoded once and
    remembered by a number into one array of ids.

    A chunk of Latin letters, with or without a final full stop or comma, is one
    word to the vocabulary: its lower-case bytes go to the model itself. All other
    chunks go through the tokenizer as a whole, as it was loaded."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # how the model spells a letter: the characters that stand for the bytes of
        # its lower case. The dotted capital I becomes two characters, so it is none.
        spelling = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [c for c in map(chr, range(LATIN)) if c.isalpha() and c != DOTTED]
        self.spelled = {ord(c): spelling.pre_tokenize_str(c.lower())[0][0] for c in letters}
        self.marks = {m: self.tokenizer.encode(m, add_special_tokens=False).ids for m in ".,"}
        self.numbers: dict[str, int] = {}
        self.first = self.size = np.empty(0, np.int64)
        self.pool = np.empty(0, "<u4")

    def _encode(self, chunks: list[str]) -> list[list[int]]:
        out, odd = [], []
        tokenize, spelled, marks = self.model.tokenize, self.spelled, self.marks
        for chunk in chunks:
            core, end = (chunk[:-1], marks[chunk[-1]]) if chunk.endswith((".", ",")) else (chunk, [])
            if core.isalpha() and (core.isascii() or max(core) < LAST_LATIN and DOTTED not in core):
                out.append([t.id for t in tokenize(core.translate(spelled))] + end)
            else:
                odd.append(len(out))
                out.append([])
        for at in range(0, len(odd), 10_000):
            few = odd[at : at + 10_000]
            for i, e in zip(few, self.tokenizer.encode_batch([chunks[i] for i in few], add_special_tokens=False)):
                out[i] = e.ids
        return out

    def _forget(self, chunks: list[str]) -> None:
        """Keeps of what is remembered the chunks at hand alone."""
        kept = {c: n for c in chunks if (n := self.numbers.get(c)) is not None}
        rows = np.fromiter(kept.values(), np.int64, len(kept))
        size = self.size[rows]
        self.pool = self.pool[_ranges(self.first[rows], size)]
        self.first, self.size = np.cumsum(size) - size, size
        self.numbers = {c: i for i, c in enumerate(kept)}

    def numbers_of(self, chunks: list[str]) -> np.ndarray:
        """The numbers of distinct chunks, new ones learned."""
        new = [c for c in chunks if c not in self.numbers]
        if new and len(self.numbers) + len(new) > REMEMBERED:
            self._forget(chunks)
        if new:
            found = self._encode(new)
            size = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum()))
            self.first = np.r_[self.first, len(self.pool) + np.cumsum(size) - size]
            self.size, self.pool = np.r_[self.size, size], np.r_[self.pool, ids]
            self.numbers.update(zip(new, range(len(self.numbers), len(self.size))))
        return np.fromiter(map(self.numbers.__getitem__, chunks), np.int64, len(chunks))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null is empty."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words, ends = pc.list_flatten(lists), np.cumsum(np.asarray(pc.list_value_length(lists)))
        # the cut leaves empty chunks at white space at either end of a text
        counts, parts = np.zeros(len(words) + 1, np.int64), []
        for at in range(0, len(words), 1_000_000):
            coded = words.slice(at, 1_000_000).dictionary_encode()
            coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
            rows = self.numbers_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[np.asarray(coded.indices)]
            size = self.size[rows]
            counts[at + 1 : at + 1 + len(rows)] = size
            parts.append(self.pool[_ranges(self.first[rows], size)])
        tokens = np.concatenate([*parts, np.empty(0, "<u4")]).astype("<u4")
        bounds = np.cumsum(counts)[np.r_[0, ends].astype(np.int64)]
        return [tokens[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, … of each of several ranges, one after the other."""
    out = np.arange(int(size.sum()))
    out += np.repeat(first - (np.cumsum(size) - size), size)
    return out


_TOKENIZERS: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def cost(tokens: int) -> float:
    return LINEAR * tokens + QUADRATIC * tokens * tokens


@dataclass
class Piece:
    doc: int
    start: int
    length: int
    sequence: int
    offset: int


def assign(lengths: Sequence[tuple[int, int, int]], rooms: Sequence[int]) -> tuple[list[Piece], list[tuple[int, int, int]]]:
    """Deals (doc, start, length) to sequences with ``rooms`` tokens: descending
    cost, each to the cheapest sequence with room. Returns pieces and the rest."""
    room, spent = np.array(rooms, np.int64), np.zeros(len(rooms))
    size = room.copy()
    heap = [(-length, doc, start) for doc, start, length in lengths]
    heapq.heapify(heap)
    pieces, left = [], int(room.sum())
    while heap and left:
        length, doc, start = heapq.heappop(heap)
        length = -length
        fits = np.flatnonzero(room >= length)
        if not len(fits):
            fits = np.flatnonzero(room > 0)
        to = int(fits[np.argmin(spent[fits])])
        take = min(length, int(room[to]))
        pieces.append(Piece(doc, start, take, to, int(size[to] - room[to])))
        room[to] -= take
        spent[to] += cost(take)
        left -= take
        if take < length:
            heapq.heappush(heap, (take - length, doc, start + take))
    return pieces, [(doc, start, -length) for length, doc, start in heap]


def powers(tokens: int) -> list[int]:
    """Falling powers of two that sum to ``tokens``."""
    return [1 << b for b in range(tokens.bit_length() - 1, -1, -1) if tokens >> b & 1]


class _Packer:
    """One task's windows and the numbers of its sequences."""

    def __init__(self, length: int, first: int) -> None:
        self.length, self.next = length, first
        self.docs: dict[int, tuple] = {}  # doc -> (id, tokens)
        self.open: list[tuple[int, int, int]] = []
        self.rows: list[tuple] = []
        self.waiting = 0
        self.count = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        doc, self.count = self.count, self.count + 1
        self.docs[doc] = (doc_id, ids)
        whole = len(ids) // self.length * self.length
        for start in range(0, whole, self.length):
            self._emit(Piece(doc, start, self.length, 0, 0))
            self.next += 1
        if whole < len(ids):
            self.open.append((doc, whole, len(ids) - whole))
            self.waiting += len(ids) - whole
        else:
            del self.docs[doc]

    def _emit(self, p: Piece) -> None:
        doc_id, ids = self.docs[p.doc]
        part = np.ascontiguousarray(ids[p.start : p.start + p.length], "<u4")
        self.rows.append((doc_id, p.start, p.length, zlib.crc32(part.tobytes()), len(ids), self.next + p.sequence, p.offset))

    def pack(self, last: bool) -> None:
        rooms = [self.length] * (self.waiting // self.length)
        if last:
            rooms += powers(self.waiting % self.length)
        pieces, rest = assign(self.open, rooms)
        for p in pieces:
            self._emit(p)
        self.next += len(rooms)
        self.open, self.waiting = rest, sum(n for _, _, n in rest)
        self.docs = {doc: self.docs[doc] for doc, _, _ in rest}

    def drain(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(schema)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end: int = END, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    ``path`` names the vocabulary file. A document's ids are those of its whole
    text and then ``end``; a null or empty text has ``end`` alone. Every id is
    in exactly one piece, and pieces fill their sequence without a gap.
    Sequences hold ``length`` ids, at the end of a task a smaller power of two
    (``length`` must be one). Rows alike are packed each for itself. The
    number of the task leads a sequence's id.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    few = pick(docs, id_col, text_col).toDF("doc_id", "text")
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType([T.StructField("doc_id", few.schema["doc_id"].dataType)] + [T.StructField(n, T.LongType()) for n in names])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        packer = _Packer(length, TaskContext.get().partitionId() << 40)
        out = None
        for batch in batches:
            out = out or pa.schema([pa.field("doc_id", batch.schema.field(0).type)] + [pa.field(n, pa.int64()) for n in names])
            texts = batch.column(1)
            sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).cumsum()
            parts = np.flatnonzero(np.diff(sizes // SLICE_BYTES)) + 1
            for a, b in zip([0, *parts], [*parts, batch.num_rows]):
                ids = tokenizer.encode(texts.slice(a, b - a))
                for doc_id, own in zip(batch.column(0).slice(a, b - a).to_pylist(), ids):
                    packer.add(doc_id, np.append(own, np.uint32(end)))
                    if packer.waiting >= window:
                        packer.pack(last=False)
            if packer.rows:
                yield packer.drain(out)
        packer.pack(last=True)
        if packer.rows:
            yield packer.drain(out)
        pa.default_memory_pool().release_unused()  # the worker lives on for other tasks

    return few.mapInArrow(run, schema)
