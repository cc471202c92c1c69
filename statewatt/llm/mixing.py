"""Mixing sources to target weights over a training run, in DataFrame functions.

Every source has a weight schedule over the run, from time 0 to 1. Its integral
is the source's weight, from which its target in words follows; its course says
when those words are wanted. A source's documents, in an order drawn by hash,
are read again and again until the target is met; each reading starts at some
count of words, and the time at which the source's cumulative demand reaches
that count is the document's training position.

No source, however large, meets in one task: words before a document are the
words of the hash buckets before its own plus those before it in its bucket,
and there are as many buckets as a bucket has rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statewatt.llm.common import WORD, cut, pick
from statewatt.operators.ordering import with_position

#: Weights by source in code point order, repeating, and readings at most.
WEIGHTS = (5, 2, 1)
READINGS = 3
Knots = Sequence[tuple[float, float]]
#: Courses, repeating like the weights: heavy sources fade, light ones come late.
COURSES: tuple[Knots, ...] = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.5), (1.0, 2.5)))


def _curve(knots: Knots) -> list[tuple[float, float, float, float]]:
    """(time, rate, slope, integral so far) of each piece, scaled to integral 1."""
    if [k[0] for k in knots] != sorted({k[0] for k in knots}) or knots[0][0] != 0 or knots[-1][0] != 1:
        raise ValueError("knots must rise from time 0 to time 1")
    whole = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
    if whole <= 0 or min(k[1] for k in knots) < 0:
        raise ValueError("a schedule needs rates of zero or more and a positive integral")
    pieces, done = [], 0.0
    for (t0, r0), (t1, r1) in zip(knots, knots[1:]):
        pieces.append((t0, r0 / whole, (r1 - r0) / whole / (t1 - t0), done))
        done += (t1 - t0) * (r0 + r1) / 2 / whole
    return pieces


def time_of(share: Column, knots: Knots) -> Column:
    """When the integral of a schedule reaches ``share`` of its whole."""
    found: Column | None = None
    for t, rate, slope, done in _curve(knots):
        more = F.greatest(share - F.lit(done), F.lit(0.0))
        root = F.lit(rate) + F.sqrt(F.greatest(F.lit(rate * rate) + F.lit(2 * slope) * more, F.lit(0.0)))
        here = F.least(F.lit(t) + F.when(root > 0, 2 * more / root).otherwise(F.lit(0.0)), F.lit(1.0))
        found = here if found is None else F.when(share >= F.lit(done), here).otherwise(found)
    return found


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, readings: int = READINGS) -> DataFrame:
    """Adds position, weight and target to (source, source_size).

    Targets share the words of all sources by weight, but none exceeds
    ``readings`` times its source; the excess is shared by weight among the
    others until none does. The level at which that holds only rises, so a few
    sums over the sources find it.
    """
    own = with_position(sources, [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    own = cut(own.withColumn("weight", weight))
    cap = (readings * F.col("source_size")).cast("double")
    first = own.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total, level, full = first["size"] or 0, 0.0, -1
    if total:
        level = total / first["weight"]
        while True:
            over = cap <= F.lit(level) * F.col("weight")
            got = own.agg(F.sum(over.cast("long")).alias("n"), F.sum(F.when(over, readings * F.col("source_size"))).alias("size"), F.sum(F.when(~over, F.col("weight"))).alias("weight")).first()
            if got["n"] == full or not got["weight"]:
                break
            full, level = got["n"], (total - (got["size"] or 0)) / got["weight"]
    return own.withColumn("target", F.least(cap, F.lit(float(level)) * F.col("weight")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS, readings: int = READINGS, drawn: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target,
    taken, before and class.

    ``size`` counts words, a null text has none. A null source is a source of
    its own, last in order. ``before`` is the number of the source's words that
    its order puts ahead; ``taken`` the words that all readings take, where the
    last reading ends inside a document at the very word the target names.
    Rows alike in id and size may stand for each other; all else is fixed by
    the rows, so reruns agree. ``drawn`` names the id, or the field of it, whose
    hash orders a source.
    """
    few = pick(docs, id_col, text_col, source_col).toDF("doc_id", "text", "source")
    sized = cut(few.select("doc_id", "source", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size")))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sources = cut(targets(sources, weights, readings).withColumn("class", F.col("position") % len(weights)))
    rows = sources.agg(F.sum("rows").alias("n")).first()["n"] or 0
    buckets = max(1, math.isqrt(rows))
    order = F.md5(F.coalesce(F.col(drawn).cast("string"), F.lit("")).cast("binary"))
    facts = sources.select(F.col("source").alias("s"), F.col("position").alias("place"), "source_size", "target", "class")
    placed = sized.join(facts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    placed = placed.withColumn("order", order)
    placed = placed.withColumn("bucket", F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("double") * buckets / 4294967296.0).cast("long"))
    sums = placed.groupBy("place", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("place", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("place", "bucket").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(sums, ["place", "bucket"]).withColumn("before", F.col("ahead") + F.col("inside"))
    words = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size")).cast("long")).otherwise(F.lit(0).cast("long"))
    rest = words - whole * F.col("source_size")
    taken = whole * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("before")))
    return placed.withColumn("taken", taken).select("doc_id", "source", "size", "source_size", "target", "taken", "before", "class")


def position(mixed: DataFrame, reading: Column, courses: Sequence[Knots] = COURSES) -> Column:
    """The training time at which a reading (0 the first) of a document begins."""
    start = (reading * F.col("source_size") + F.col("before")).cast("double") / F.col("target")
    found: Column | None = None
    for at, knots in enumerate(courses):
        here = time_of(F.least(start, F.lit(1.0)), knots)
        found = here if found is None else F.when(F.col("class") % len(courses) == at, here).otherwise(found)
    return F.when(F.col("target") > 0, found)


def curriculum(mixed: DataFrame, courses: Sequence[Knots] = COURSES) -> DataFrame:
    """Every reading that takes words: the columns of ``mix``, ``reading``,
    ``words`` it takes and ``position``; range-sorted by position."""
    words = F.floor("target").cast("long")
    last = F.when(F.col("taken") > 0, F.ceil(F.col("taken") / F.col("size")).cast("long") - 1)
    each = mixed.where(F.col("taken") > 0).withColumn("reading", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    start = F.col("reading") * F.col("source_size") + F.col("before")
    each = each.withColumn("words", F.least(F.col("size"), words - start)).withColumn("position", position(each, F.col("reading"), courses))
    return each.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS, readings: int = READINGS) -> DataFrame:
    """The rows of ``docs`` as the mix reads them, in training order: a row comes
    once for each reading that takes at least half of its words, with all its
    columns and its whole text. Rows alike in id, text and source stand for
    each other; documents without words are not read."""
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    i, t, s = (f"c{docs.columns.index(c)}" for c in (id_col, text_col, source_col))
    key = F.struct(F.col(i).alias("i"), F.xxhash64(t).alias("t"), F.col(s).alias("s"))
    named = flat.select(key.alias("doc_id"), F.col(t).alias("text"), F.col(s).alias("source"))
    each = mix(named, weights=weights, readings=readings, drawn="doc_id.i").where("taken > 0")
    last = F.ceil(F.col("taken") / F.col("size")).cast("long") - 1
    each = each.withColumn("reading", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    start = F.col("reading") * F.col("source_size") + F.col("before")
    words = F.least(F.col("size"), F.floor("target").cast("long") - start)
    each = each.where(2 * words >= F.col("size")).withColumn("at", position(each, F.col("reading")))
    plan = cut(each.groupBy(F.hash("doc_id").alias("h"), F.col("doc_id").alias("k")).agg(F.collect_list("at").alias("at")))
    first = Window.partitionBy("k").orderBy("h")
    joined = flat.withColumn("_k", key).join(plan, (F.col("_k") == F.col("k")))
    joined = joined.withColumn("_n", F.row_number().over(first)).where("_n = 1").withColumn("_at", F.explode("at"))
    columns = [f"c{n}" for n in range(len(docs.columns))]
    return joined.repartitionByRange("_at", i).sortWithinPartitions("_at", i).select(*columns).toDF(*docs.columns)
