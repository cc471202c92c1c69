"""Toxicity by non-negative positive-unlabelled learning.

A linear model over hashed words and their beginnings is trained with numpy
from confirmed toxic texts and unlabelled ones. The risk of the unlabelled
texts, less what the toxic ones among them account for by the class prior, may
not fall below zero; where it does, the step undoes the overfit instead
(the estimator of Kiryo et al., 2017). Only the learning sample is bounded;
every whole text is scored, in place, against weights of a fixed size.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewatt.llm.common import cut, pick

#: Hashed feature slots, and the lengths of word beginnings that are features.
SLOTS = 1 << 18
PREFIXES = (4, 5, 6)
#: Bounds of the learning sample: confirmed toxic rows and unlabelled rows.
TOXIC_ROWS = 4_000
PLAIN_ROWS = 8_000
#: A slot is a feature if so many toxic sample rows hold it and it is so many
#: standard deviations more frequent there than among the unlabelled ones.
LEAST_ROWS, LEAST_Z = 3, 4.0
#: Words whose slots or weights a task remembers.
REMEMBERED = 200_000
EDGES = ".,;:!?\"'()[]{}<>«»„“”‚‘’…-–—*_"


def word_features(word: str) -> list[int]:
    """Slots of a word as split at white space: the word and its beginnings."""
    core = word.strip(EDGES)
    if not core:
        return []
    parts = [core, *(f"{core[:n]}\n" for n in PREFIXES if len(core) >= n)]
    return [zlib.crc32(p.encode("utf-8", "replace")) % SLOTS for p in parts]


class _Memory(dict):
    """A word table that starts anew when it is full."""

    def __init__(self, make: Callable[[str], object]) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, word: str):
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = self.make(word)
        return value


@dataclass
class Rows:
    """Sparse 0/1 rows: slots, and where each row begins."""

    slots: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, rows: Sequence[np.ndarray]) -> Rows:
        return cls(np.concatenate([*rows, np.empty(0)]).astype(np.int64), np.cumsum([0] + [len(r) for r in rows]))

    def __len__(self) -> int:
        return len(self.starts) - 1

    def dot(self, w: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(w[self.slots])])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.slots, np.repeat(g, np.diff(self.starts)), size)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def fit_nnpu(toxic: Rows, plain: Rows, prior: float, size: int, steps: int = 300, rate: float = 0.1, decay: float = 1e-3) -> np.ndarray:
    """``size`` weights and, last, the offset, by full-batch Adam on the corrected risk."""
    w = np.zeros(size + 1)
    w[-1] = -1.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        zp, zu = toxic.dot(w[:-1]) + w[-1], plain.dot(w[:-1]) + w[-1]
        sp, su = _sigmoid(zp), _sigmoid(zu)
        # logistic loss: -log s(z) for the class, -log s(-z) against it
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp, gu = -prior * sp / len(zp), su / len(zu)
        if negative >= 0:
            gp = gp + prior * (sp - 1) / len(zp)
        else:
            gp, gu = -gp, -gu
        g = np.append(toxic.back(gp, size) + plain.back(gu, size), gp.sum() + gu.sum()) + decay * w
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


@dataclass
class Model:
    """Weights by slot and the offset; slots without one weigh nothing."""

    weights: dict[int, float]
    offset: float

    def scorer(self) -> Callable[[str | None], float]:
        weights = self.weights
        memory = _Memory(lambda word: sum(weights.get(s, 0.0) for s in word_features(word)))

        def score(text: str | None) -> float:
            z = self.offset + sum(map(memory.__getitem__, set((text or "").lower().split())))
            return float(_sigmoid(np.float64(z)))

        return score


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _slots(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory = _Memory(word_features)
    for batch in batches:
        own = [sorted({s for w in set((t or "").lower().split()) for s in memory[w]}) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(pa.int32()))], ["toxic", "slots"])


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, plain_rows: int = PLAIN_ROWS) -> Model:
    """Learns from (doc_id, toxic) and (doc_id, text).

    Positives are at most ``toxic_rows`` texts labelled 1 outside the held-out
    fifth, unlabelled ones at most ``plain_rows`` of all rows outside it, labelled or
    not, both chosen by a hash of the id; equal texts count once. The class prior is
    the share of ones among all labels outside the held-out fifth. Without a
    toxic text, or without features, every score is that of the offset alone.
    """
    docs, labels = pick(docs, "doc_id", "text"), pick(labels, "doc_id", "toxic")
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("double")).alias("p")).first()["p"] or 0.0
    order = [F.xxhash64("doc_id"), "doc_id"]
    positive = known.where("toxic = 1").select("doc_id").distinct()
    positive = cut(positive.orderBy(*order).limit(toxic_rows).withColumn("toxic", F.lit(1)))
    free = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    plain = free.select("doc_id").distinct().orderBy(*order).limit(plain_rows).withColumn("toxic", F.lit(0))
    chosen = cut(positive.unionAll(plain))  # at most toxic_rows + plain_rows ids: the bound of the broadcasts
    texts = docs.where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id").dropDuplicates(["toxic", "doc_id"]).dropDuplicates(["toxic", "text"])
    rows = cut(texts.select("toxic", "text").mapInArrow(_slots, "toxic int, slots array<int>"))
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_plain = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_plain:
        return Model({}, -1.0)
    by_slot = rows.select("toxic", F.explode("slots").alias("slot")).groupBy("slot").agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("u"))
    expected = (F.col("u") + 1) * F.lit(n_toxic / n_plain)
    telling = by_slot.where((F.col("p") >= LEAST_ROWS) & ((F.col("p") - expected) / F.sqrt(expected + 1) >= LEAST_Z))
    kept = np.array(sorted(r["slot"] for r in telling.select("slot").collect()), np.int64)
    if not len(kept):
        return Model({}, -1.0)
    few = rows.select("toxic", F.array_intersect("slots", F.array(*[F.lit(int(s)) for s in kept])).alias("slots")).collect()
    place = {int(s): i for i, s in enumerate(kept)}
    own = [Rows.of([np.array(sorted(place[s] for s in r["slots"]), np.int64) for r in few if r["toxic"] == side]) for side in (1, 0)]
    w = fit_nnpu(own[0], own[1], prior, len(kept))
    return Model({int(s): float(x) for s, x in zip(kept, w)}, float(w[-1]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; the whole text alone decides. Null texts
    score like empty ones."""
    few = pick(docs, id_col, text_col).toDF("doc_id", "text")
    schema = T.StructType([few.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rate = model.scorer()
        for batch in batches:
            found = [rate(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return few.mapInArrow(run, schema)


def clean(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is below ``limit``."""
    at = docs.columns.index(text_col)
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rate = model.scorer()
        for batch in batches:
            yield batch.filter(pa.array([rate(t.as_py()) < limit for t in batch.column(at)], pa.bool_()))

    return flat.mapInArrow(run, flat.schema).toDF(*docs.columns)
