"""Quantile buckets and competition ranks over a whole table.

A window without PARTITION BY would move every row to one task. Buckets need no
order of all rows, only the keys at which they begin: those are selected. A
sample of the rows brackets each cut, a pass counts the rows below and inside the
bracket, and so on until a bracket holds few keys, which tell the cut exactly;
a row's bucket is then a comparison with the cuts. Ranks range-partition the
distinct values instead. The plans are the same for a table of any size.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statewatt.session import stored

#: Keys of a bracket that are looked at one by one; keys of a sample.
HELD = 20_000
SAMPLE = 10_000


@dataclass(frozen=True)
class _Bracket:
    """Rows of ranked column ``d`` with a key above ``after``, up to ``upto``
    (None: no end): ``rows`` of them, ``below`` rows of the column before them."""

    d: int
    after: tuple | None
    upto: tuple | None
    below: int
    rows: int
    single: bool = False

    def holds(self, keys: "_Keys") -> Column:
        inside = F.col("_d") == self.d
        if self.after is not None:
            inside &= keys.column > keys.literal(self.after)
        if self.upto is not None:
            inside &= keys.column <= keys.literal(self.upto)
        return inside


class _Keys:
    """The keys of a table (_d, fields): what its rows are ordered by, NULLs first."""

    def __init__(self, df: DataFrame, fields: Sequence[str]) -> None:
        self.df, self.fields = df, list(fields)
        self.types = [df.schema[f].dataType for f in fields]
        self.column = F.struct(*fields)

    def literal(self, key: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(f) for v, t, f in zip(key, self.types, self.fields)])

    def of(self, brackets: Sequence[_Bracket], most: int | None = None, seed: int = 0) -> list[list[tuple[tuple, int]]]:
        """The distinct keys in each bracket, in order, with their rows; of ``most``
        rows or so if it is given."""
        drawn = self.df.withColumn("_u", F.rand(seed) if most else F.lit(0.0))
        chosen = [b.holds(self) & (F.col("_u") < (most / b.rows if most else 1.0)) for b in brackets]
        each = F.explode(F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(chosen)])))
        counts = drawn.select(each.alias("_b"), *self.fields).groupBy("_b", *self.fields).agg(F.count(F.lit(1)).alias("_n"))
        out: list[list[tuple[tuple, int]]] = [[] for _ in brackets]
        for r in counts.orderBy("_b", *[F.col(f).asc_nulls_first() for f in self.fields]).collect():
            out[r["_b"]].append((tuple(r[f] for f in self.fields), r["_n"]))
        return out

    def counts(self, asked: Sequence[tuple[_Bracket, tuple, tuple]]) -> list[tuple[int, int, bool]]:
        """Of (bracket, x, y): rows up to x, rows up to y, whether all keys are one."""
        columns = []
        for i, (b, x, y) in enumerate(asked):
            inside = b.holds(self)
            own = F.when(inside, self.column)
            columns += [F.count_if(inside & (self.column <= self.literal(k))).alias(f"_{n}{i}") for n, k in (("x", x), ("y", y))]
            columns.append((F.min(own) == F.max(own)).alias(f"_s{i}"))
        r = self.df.agg(*columns).first()
        return [(r[f"_x{i}"], r[f"_y{i}"], bool(r[f"_s{i}"])) for i in range(len(asked))]


def _narrowed(keys: _Keys, wanted: Mapping[tuple[int, int], _Bracket], turn: int) -> dict[tuple[int, int], _Bracket]:
    """The brackets of the wanted (column, place) after one more sample and count."""
    wide = list(dict.fromkeys(b for b in wanted.values() if b.rows > HELD and not b.single))
    found = keys.of(wide, SAMPLE, turn)
    asked, names = [], []
    for (d, place), b in wanted.items():
        if b not in wide or not (sample := found[wide.index(b)]):
            continue
        total, share = sum(n for _, n in sample), (place - b.below) / b.rows
        spare = 2 / math.sqrt(len(sample))
        ends = []
        for bound in (share - spare, share + spare):
            seen = 0
            for key, n in sample:
                seen += n
                if seen >= bound * total:
                    break
            ends.append(key)
        asked.append((b, *ends))
        names.append((d, place))
    out = dict(wanted)
    for (d, place), (b, x, y), (to_x, to_y, single) in zip(names, asked, keys.counts(asked) if asked else []):
        at = place - b.below
        if single:
            out[d, place] = replace(b, single=True)
        elif at < to_x:
            out[d, place] = replace(b, upto=x, rows=to_x)
        elif at < to_y:
            out[d, place] = replace(b, after=x, upto=y, below=b.below + to_x, rows=to_y - to_x)
        else:
            out[d, place] = replace(b, after=y, below=b.below + to_y, rows=b.rows - to_y)
    return out


def _cuts(keys: _Keys, n: int) -> tuple[dict[int, list[tuple]], bool]:
    """The keys at which the buckets 2..n of each ranked column begin, and
    whether rows with one key fall on both sides of some cut. Sizes of buckets
    differ by at most one and the larger come first."""
    sizes = {r["_d"]: r["_n"] for r in keys.df.groupBy("_d").agg(F.count(F.lit(1)).alias("_n")).collect()}  # a row for each ranked column
    starts = {(d, k * (rows // n) + min(k, rows % n)): rows for d, rows in sizes.items() for k in range(1, n)}
    wanted = {(d, at): _Bracket(d, None, None, 0, rows) for (d, at), rows in starts.items() if at < rows}
    turn = 0
    while any(b.rows > HELD and not b.single for b in wanted.values()):
        wanted, turn = _narrowed(keys, wanted, turn), turn + 1
    few = list(dict.fromkeys(wanted.values()))
    held = dict(zip(few, keys.of(few))) if few else {}
    cuts: dict[int, list[tuple]] = {d: [] for d in sizes}
    torn = False
    for (d, place), b in sorted(wanted.items(), key=lambda w: w[0]):
        before = b.below
        for key, rows in held[b]:
            if place < before + rows:
                break
            before += rows
        cuts[d].append(key)
        torn |= before != place
    return cuts, torn


def _bucket(keys: _Keys, own: Column, cuts: Sequence[tuple]) -> Column:
    return reduce(lambda total, cut: total + (own >= keys.literal(cut)).cast("int"), cuts, F.lit(1))


def ntile_score(df: DataFrame, col: str, out: str, n: int = 5, tie: Sequence[str] = ()) -> DataFrame:
    """Ascending bucket 1..n over the whole table; NULLs sort first.

    ``tie`` should make the order total, else rows that tie across a bucket
    border may swap.
    """
    return ntile_scores(df, {out: col}, n, tie)


def _ranked_rows(df: DataFrame, columns: Mapping[int, str], kinds: Sequence[str], keep: Sequence[Column]) -> DataFrame:
    """A row for each row and ranked column: ``keep``, the column's number and
    its value, which stands in the field of its type."""
    rows = F.array(*[F.struct(F.lit(d).alias("_d"), *[v.alias(f"_v{i}") for i, v in enumerate(_value(df, c, kinds))]) for d, c in columns.items()])
    return df.select(*keep, F.inline(rows))


def _value(df: DataFrame, c: str, kinds: Sequence[str]) -> list[Column]:
    own = df.schema[c].dataType.simpleString()
    return [F.col(c) if own == k else F.lit(None).cast(k) for k in kinds]


def _kinds(tables: Sequence[tuple[DataFrame, Sequence[str]]]) -> list[str]:
    return list(dict.fromkeys(df.schema[c].dataType.simpleString() for df, columns in tables for c in columns))


def ntile_scores(df: DataFrame, scores: Mapping[str, str], n: int = 5, tie: Sequence[str] = ()) -> DataFrame:
    """Several bucket columns, ``scores`` mapping output -> ranked column.

    All columns share the passes that select their cuts. Only where rows that
    agree in value and ties fall on both sides of a cut, the number of the row in
    the stored table parts them.
    """
    columns = list(dict.fromkeys(scores.values()))
    kinds = _kinds([(df, columns)])
    base = stored(df.withColumn("_row", F.monotonically_increasing_id()))
    ties = {f"_t{i}": t for i, t in enumerate(dict.fromkeys(tie))}
    torn = True
    for ties in (ties, {**ties, "_t": "_row"}):
        if torn:
            fields = [*[f"_v{i}" for i in range(len(kinds))], *ties]
            keys = _Keys(_ranked_rows(base, dict(enumerate(columns)), kinds, [F.col(t).alias(o) for o, t in ties.items()]), fields)
            cuts, torn = _cuts(keys, n)
    buckets = {}
    for d, c in enumerate(columns):
        own = F.struct(*[v.alias(f) for v, f in zip([*_value(base, c, kinds), *[F.col(t) for t in ties.values()]], fields)])
        buckets[c] = _bucket(keys, own, cuts.get(d, []))
    kept = [c for c in df.columns if c not in scores]
    return base.select(*kept, *[buckets[c].alias(o) for o, c in scores.items()])


def ntile_tables(tables: Sequence[tuple[DataFrame, Mapping[str, str]]], key: str, n: int = 5) -> DataFrame:
    """(key, a bucket column per output) over several tables at once.

    Each table comes with its output -> ranked column; a column is ranked among
    the rows of its own table, ties by ``key``, which must be unique there. A
    key that a table does not list has NULL in that table's outputs.
    """
    kinds = _kinds([(df, list(scores.values())) for df, scores in tables])
    outs = [out for _, scores in tables for out in scores]
    parts, at = [], 0
    for df, scores in tables:
        parts.append(_ranked_rows(df, dict(enumerate(scores.values(), at)), kinds, [F.col(key)]))
        at += len(scores)
    keys = _Keys(stored(reduce(DataFrame.unionAll, parts)), [*[f"_v{i}" for i in range(len(kinds))], key])
    cuts, _ = _cuts(keys, n)
    return keys.df.groupBy(key).agg(*[F.max(F.when(F.col("_d") == d, _bucket(keys, keys.column, cuts.get(d, [])))).alias(o) for d, o in enumerate(outs)])


def rank_global(df: DataFrame, col: str, out: str, desc: bool = True) -> DataFrame:
    """Competition rank over the whole table: 1 + rows strictly ahead.

    NULLs come last when descending and first when ascending. Equal values are
    counted first, so a value shared by a third of the rows is one row in the
    ordering step; both sides of the join back are plain shuffles, which the
    planner may split.
    """
    direction = F.col(col).desc_nulls_last() if desc else F.col(col).asc_nulls_first()
    values = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    runs = stored(values.repartitionByRange(direction).sortWithinPartitions(direction).withColumn("_at", F.monotonically_increasing_id()))
    runs = runs.withColumn("_run", F.shiftright("_at", 33))  # the partition's number
    size = runs.groupBy("_run").agg(F.sum("_n").alias("_size"))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    first = size.select("_run", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_run").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    ranks = runs.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(F.broadcast(first), "_run")  # a row for each partition
    ranks = ranks.select(F.col(col).alias("_value"), (F.col("_first") + F.col("_in") + 1).cast("int").alias("_rank"))
    return df.join(ranks, df[col].eqNullSafe(ranks["_value"]), "left").select(*[df[c] for c in df.columns if c != out], F.col("_rank").alias(out))
