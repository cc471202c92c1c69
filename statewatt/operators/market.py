"""Class shares, weighted reliability, use-case counts and market bases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statewatt.functions import class_sum, in_years, ratio


def class_share(
    df: DataFrame,
    key: str,
    cls: str,
    vals: Mapping[str, str],
    num: Sequence[str],
    den: Sequence[str] | None = None,
    digits: int = 2,
    totals: Mapping[str, tuple[str, str]] | None = None,
    having: str | None = None,
) -> DataFrame:
    """100 x (sum over the ``num`` classes) / (sum over the ``den`` classes).

    ``vals`` maps measure -> percentage column; ``den=None`` takes all rows.
    ``totals`` maps measure -> (numerator column, denominator column), rounded
    to whole units. ``having`` keeps keys whose total of that measure is > 0.
    """
    aggs: list[Column] = []
    for val, out in vals.items():
        n = class_sum(cls, num, val)
        d = F.sum(val) if den is None else class_sum(cls, den, val)
        if totals and val in totals:
            n_out, d_out = totals[val]
            aggs += [F.round(n, 0).alias(n_out), F.round(d, 0).alias(d_out)]
        aggs.append(F.round(ratio(n.cast("double"), d.cast("double")) * 100, digits).alias(out))
    if having is not None:
        aggs.append(F.sum(having).alias("_having"))
    out = df.groupBy(key).agg(*aggs)
    return out if having is None else out.filter(F.col("_having") > 0).drop("_having")


def weighted_reliability(
    df: DataFrame,
    key: str,
    val: str,
    weight: str,
    ts: str,
    years: tuple[int, int],
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Weighted mean of rows with a value and a positive weight, the weight
    total and the exact number of distinct years."""
    n = {"mean": "weighted_avg", "weight": "total_weight", "years": "years_covered"} | dict(names or {})
    v, w = F.col(val), F.col(weight)
    return (
        df.filter(v.isNotNull() & (w > 0) & in_years(ts, *years))
        .groupBy(key)
        .agg(
            F.round(ratio(F.sum(v * w), F.sum(w)), 1).alias(n["mean"]),
            F.sum(w).alias(n["weight"]),
            F.count_distinct(F.year(ts)).alias(n["years"]),
        )
    )


def dim_join_rollup(fact: DataFrame, dim: DataFrame, on: str, dim_key: str, aggs: Sequence[Column]) -> DataFrame:
    """Aggregate facts per dimension key over the distinct (on, key) pairs; a
    fact whose key has two dimension values counts in both."""
    pairs = dim.select(on, dim_key).distinct()
    return fact.join(pairs, on).groupBy(dim_key).agg(*aggs)


def flag_activation(
    df: DataFrame,
    key: str,
    flags: Mapping[str, str],
    size: str,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Row count, total size, rows per flag, and all activations together.

    A flag that is NULL on every row stays NULL in its own column and counts
    0 in the total.
    """
    n = {"count": "units", "size": "total_size", "total": "total_activations"} | dict(names or {})
    sums = {out: F.sum(F.col(flag).cast("int")) for flag, out in flags.items()}
    total = F.lit(0)
    for s in sums.values():
        total = total + F.coalesce(s, F.lit(0))
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias(n["count"]),
        F.round(F.sum(size), 0).alias(n["size"]),
        *[s.alias(out) for out, s in sums.items()],
        total.alias(n["total"]),
    )


def m2m_left_sums(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    key: str,
    left_vals: Mapping[str, str],
    right_vals: Mapping[str, str],
    digits: int | None = 0,
    fanout: str = "keep",
) -> DataFrame:
    """Sums per ``key`` after a many-to-many left join, without the join's rows.

    With ``fanout='keep'`` a left row counts once per match and a right row
    once per left row, as the plain join would; ``'dedup'`` counts each row
    once. Both sides meet with one row per join key.
    """
    if key not in on:
        raise ValueError("the roll-up key must be one of the join keys")
    if fanout not in ("keep", "dedup"):
        raise ValueError(f"fanout must be 'keep' or 'dedup', not {fanout!r}")
    ls = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_nl"), *[F.sum(v).alias(f"_l{i}") for i, v in enumerate(left_vals)])
    rs = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_nr"), *[F.sum(v).alias(f"_r{i}") for i, v in enumerate(right_vals)])
    keep = fanout == "keep"
    l_times = F.coalesce(F.col("_nr"), F.lit(1)) if keep else F.lit(1)
    r_times = F.col("_nl") if keep else F.lit(1)

    def whole(c: Column) -> Column:
        return c if digits is None else F.round(c, digits)

    aggs = [whole(F.sum(F.col(f"_l{i}") * l_times)).alias(out) for i, out in enumerate(left_vals.values())]
    aggs += [
        F.coalesce(whole(F.sum(F.col(f"_r{i}") * r_times)), F.lit(0)).alias(out)
        for i, out in enumerate(right_vals.values())
    ]
    return ls.join(rs, list(on), "left").groupBy(key).agg(*aggs)


def market_base(
    df: DataFrame,
    key: str,
    sums: Mapping[str, tuple[str, Sequence[str] | None]],
    ratios: Mapping[str, tuple[str, str]],
    cls: str,
    positive_only: bool = True,
) -> DataFrame:
    """Per-class sums and unit ratios derived from them.

    ``sums`` maps output -> (measure, classes or None for all rows); ``ratios``
    maps output -> (numerator output, denominator output), NULL where the
    denominator is 0 and, with ``positive_only``, where it is negative.
    """
    aggs = [
        (F.sum(val) if classes is None else class_sum(cls, classes, val)).alias(out)
        for out, (val, classes) in sums.items()
    ]
    base = df.groupBy(key).agg(*aggs)

    def unit(num: str, den: str) -> Column:
        n, d = F.col(num).cast("double"), F.col(den).cast("double")
        return F.when(d > 0, ratio(n, d)) if positive_only else ratio(n, d)

    return base.withColumns({out: unit(n, d) for out, (n, d) in ratios.items()})


def having_semi(df: DataFrame, key: str, allowed: DataFrame) -> DataFrame:
    """Rows whose key occurs in ``allowed``; filters before any aggregation.

    The allowed keys are made distinct first, so a key that fills the list
    travels once.
    """
    return df.join(allowed.select(key).distinct(), key, "left_semi")
