"""Period roll-ups, series profiles, shares, shifts and unit costs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statewatt.functions import class_sum, month_period, ratio, value_map
from statewatt.functions import since as since_day


def monthly_rollup(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    dim_keys: Sequence[str],
    fact_keys: Sequence[str],
    ts: str,
    val: str,
    out: str,
    since: str | None = None,
    fanout: str = "keep",
    period: str = "period",
) -> DataFrame:
    """Sum ``val`` per (dim_keys, fact_keys, month) over a many-to-many join.

    ``fanout='keep'`` counts a fact row once per matching dimension row;
    ``'dedup'`` once per distinct dimension key. Both sides are aggregated to
    the join key first, so the join never multiplies rows and a hot key
    reaches it as a handful of partial sums; ``n`` restores the fan-out.
    """
    if fanout not in ("keep", "dedup"):
        raise ValueError(f"fanout must be 'keep' or 'dedup', not {fanout!r}")
    if since is not None:
        fact = fact.filter(since_day(ts, since))
        if ts in on:
            dim = dim.filter(since_day(ts, since))
    for k in dim_keys:
        dim = dim.filter(F.col(k).isNotNull())
    carried = [c for c in fact_keys if c not in on]
    if ts in on:
        facts = fact.groupBy(*on, *carried).agg(F.sum(val).alias("_s"))
        facts = facts.withColumn(period, month_period(ts))
    else:
        facts = fact.groupBy(*on, *carried, month_period(ts).alias(period)).agg(F.sum(val).alias("_s"))
    n = F.count(F.lit(1)) if fanout == "keep" else F.lit(1)
    dims = dim.groupBy(*on, *[c for c in dim_keys if c not in on]).agg(n.alias("_n"))
    return (
        facts.join(dims, list(on))
        .groupBy(*dim_keys, *fact_keys, period)
        .agg(F.sum(F.col("_s") * F.col("_n")).alias(out))
    )


@dataclass(frozen=True)
class Profile:
    """Which statistics of ``value`` to compute, by output column name.

    The coefficient of variation divides by the mean of ``cv_base`` if given,
    else by the mean of the value itself; it is NULL where that mean is 0.
    """

    value: Column
    names: Mapping[str, str] = field(default_factory=dict)
    cv_base: Column | None = None

    def aggregates(self) -> list[Column]:
        v = self.value
        base = v if self.cv_base is None else self.cv_base
        stats = {
            "avg": lambda: F.avg(v),
            "total": lambda: F.sum(v),
            "stddev": lambda: F.stddev_pop(v),
            "max": lambda: F.max(v),
            "min": lambda: F.min(v),
            "range": lambda: F.max(v) - F.min(v),
            "cv": lambda: F.try_divide(F.stddev_pop(v), F.avg(base)),
        }
        return [stats[stat]().alias(out) for stat, out in self.names.items()]


def series_profile(df: DataFrame, keys: Sequence[str], profiles: Sequence[Profile]) -> DataFrame:
    """Mean, spread and extremes of several series in one aggregation."""
    return df.groupBy(*keys).agg(*[a for p in profiles for a in p.aggregates()])


def weighted_rollup(
    df: DataFrame,
    key: str,
    weight: str,
    means: Sequence[str],
    maxes: Sequence[str] = (),
    mins: Sequence[str] = (),
    ranges: Mapping[str, tuple[str, str]] | None = None,
    cvs: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Roll finer rows up to ``key`` with one weight for every mean.

    The weight sum includes rows whose measure is NULL. Coefficients of
    variation are recomputed from the rolled-up spread and mean.
    """
    w = F.col(weight)
    aggs = [ratio(F.sum(F.col(m) * w), F.sum(w)).alias(m) for m in means]
    aggs += [F.max(m).alias(m) for m in maxes]
    aggs += [F.min(m).alias(m) for m in mins]
    out = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    derived = {name: F.col(hi) - F.col(lo) for name, (hi, lo) in (ranges or {}).items()}
    derived |= {name: ratio(F.col(sd), F.col(mean)) for name, (sd, mean) in (cvs or {}).items()}
    return out.withColumns(derived) if derived else out


def category_shares(
    df: DataFrame,
    key: str,
    cat: str,
    val: str,
    groups: Mapping[str, Sequence[str]],
    share: str = "share",
    drop_null_cat: bool = True,
) -> DataFrame:
    """Share of each category in its key's total, and group shares per row.

    ``df`` holds one row per (key, cat); the window therefore sees only as
    many rows per key as there are categories. Rows without a category count
    in the total and are dropped afterwards, so shares need not sum to 1.
    """
    w = Window.partitionBy(key)
    total = F.sum(val).over(w).cast("double")
    out = {share: ratio(F.col(val).cast("double"), total)}
    for name, members in groups.items():
        out[name] = ratio(class_sum(cat, members, val).over(w).cast("double"), total)
    result = df.filter(F.col(key).isNotNull()).withColumns(out)
    return result.filter(F.col(cat).isNotNull()) if drop_null_cat else result


def concentration(df: DataFrame, key: str, cat: str, share: str, names: Mapping[str, str] | None = None) -> DataFrame:
    """Concentration index, category count, top share and top category.

    Equal top shares go to the greatest category name.
    """
    n = {"hhi": "hhi", "count": "categories", "top_share": "top_share", "top": "top_category"} | dict(names or {})
    top = F.max(F.when(F.col(share).isNotNull(), F.struct(F.col(share), F.col(cat))))
    return df.groupBy(key).agg(
        F.round(F.sum(F.col(share) * F.col(share)), 4).alias(n["hhi"]),
        F.count(cat).alias(n["count"]),
        F.max(share).alias(n["top_share"]),
        top.getField(cat).alias(n["top"]),
    )


def period_shift(
    df: DataFrame,
    key: str,
    year: Column,
    cat: str,
    val: str,
    groups: Mapping[str, Sequence[str]],
    early: Sequence[str],
    late: Sequence[str],
    changes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Average of rounded annual shares, early against late, and the change.

    Only keys with at least one annual row in both periods are kept; a year
    whose total is 0 has a NULL share yet still counts as a row.
    """
    changes = changes or {}
    annual = (
        df.withColumn("_year", year)
        .filter(F.col("_year").isin([*early, *late]))
        .groupBy(key, "_year")
        .agg(F.sum(val).cast("double").alias("_total"), *[class_sum(cat, m, val).cast("double").alias(g) for g, m in groups.items()])
    )
    shares = annual.select(key, "_year", *[F.round(ratio(g, "_total"), 4).alias(g) for g in groups])
    is_early, is_late = F.col("_year").isin(list(early)), F.col("_year").isin(list(late))
    aggs = [F.count_if(is_early).alias("_n_early"), F.count_if(is_late).alias("_n_late")]
    for g in groups:
        aggs += [F.avg(F.when(is_early, F.col(g))).alias(f"_e_{g}"), F.avg(F.when(is_late, F.col(g))).alias(f"_l_{g}")]
    both = shares.groupBy(key).agg(*aggs).filter((F.col("_n_early") > 0) & (F.col("_n_late") > 0))
    cols = [F.col(key)]
    for g in groups:
        e, l = F.col(f"_e_{g}"), F.col(f"_l_{g}")
        cols += [
            F.round(e, 4).alias(f"early_{g}"),
            F.round(l, 4).alias(f"late_{g}"),
            F.round(l - e, 4).alias(changes.get(g, f"{g}_change")),
        ]
    return both.filter(F.col(key).isNotNull()).select(*cols)


def volume_weighted_price(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    cost: str,
    volume: str,
    unit_cost: str,
    names: Mapping[str, str] | None = None,
    since: str | None = None,
    period: str = "period",
) -> DataFrame:
    """Monthly total cost over total volume, with unit-cost extremes and the
    number of rows that lack a unit cost."""
    n = {
        "price": "avg_price",
        "min": "min_price",
        "max": "max_price",
        "volume": "total_volume",
        "cost": "total_cost",
        "rows": "record_count",
        "nulls": "null_count",
    } | dict(names or {})
    if since is not None:
        df = df.filter(since_day(ts, since))
    return (
        df.filter(F.col(keys[0]).isNotNull())
        .groupBy(*keys, month_period(ts).alias(period))
        .agg(
            ratio(F.sum(cost).cast("double"), F.sum(volume).cast("double")).alias(n["price"]),
            F.min(unit_cost).alias(n["min"]),
            F.max(unit_cost).alias(n["max"]),
            F.sum(volume).alias(n["volume"]),
            F.sum(cost).alias(n["cost"]),
            F.count(F.lit(1)).alias(n["rows"]),
            F.count_if(F.col(unit_cost).isNull()).alias(n["nulls"]),
        )
    )


def normalised_cost(
    df: DataFrame,
    cat: str,
    price: str,
    factors: Mapping[str, float],
    rows: str,
    nulls: str,
    factor_out: str = "factor",
    out: str = "unit_cost",
    pct_out: str = "null_pct",
) -> DataFrame:
    """Price times a per-category factor (NULL for other categories) and the
    percentage of rows without a price, exact to one place."""
    hundred = F.col(nulls).cast("decimal(20,0)") * F.lit(100).cast("decimal(4,1)")
    return df.filter(F.col(price).isNotNull()).withColumns(
        {
            pct_out: F.round(F.try_divide(hundred, F.col(rows).cast("decimal(14,0)")), 1).cast("decimal(5,1)"),
            factor_out: value_map(cat, factors),
            out: F.col(price) * value_map(cat, factors),
        }
    )


def cost_stats(
    df: DataFrame,
    keys: Sequence[str],
    cost: str,
    pct: str,
    flag_at: float,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rounded statistics over the positive costs, and a data-quality flag.

    The percentages averaged are already rounded; the flag compares their
    unrounded average.
    """
    n = {
        "count": "month_count",
        "avg": "avg_cost",
        "min": "min_cost",
        "max": "max_cost",
        "stddev": "std_dev_cost",
        "range": "cost_range",
        "cv": "cv_cost",
        "pct": "avg_null_pct",
        "flag": "high_null_flag",
    } | dict(names or {})
    c = F.col(cost)
    return (
        df.filter(c > 0)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias(n["count"]),
            F.round(F.avg(c), 2).alias(n["avg"]),
            F.round(F.min(c), 2).alias(n["min"]),
            F.round(F.max(c), 2).alias(n["max"]),
            F.round(F.stddev_pop(c), 2).alias(n["stddev"]),
            F.round(F.max(c) - F.min(c), 2).alias(n["range"]),
            F.round(F.try_divide(F.stddev_pop(c), F.avg(c)), 4).alias(n["cv"]),
            F.round(F.avg(pct), 1).alias(n["pct"]),
            F.when(F.avg(pct) >= flag_at, 1).otherwise(0).alias(n["flag"]),
        )
    )


def category_spread(
    df: DataFrame,
    key: str,
    cat: str,
    val: str,
    flag: str,
    columns: Mapping[str, str],
    spreads: Mapping[str, tuple[str, str]],
    base: str,
    flag_out: str = "any_flag",
) -> DataFrame:
    """One row per key that has the ``base`` category: each category's value,
    rounded pairwise differences and whether any side is flagged.

    ``columns`` maps category -> output column; ``spreads`` maps output column
    -> (minuend category, subtrahend category). ``df`` has one row per
    (key, cat), so a conditional maximum picks the value in a single pass.
    """
    aggs = [F.max(F.when(F.col(cat) == c, F.col(val))).alias(out) for c, out in columns.items()]
    aggs += [
        F.max(F.when(F.col(cat).isin(list(columns)), F.col(flag))).alias("_flag"),
        F.count_if(F.col(cat) == base).alias("_n"),
    ]
    wide = df.groupBy(key).agg(*aggs).filter(F.col("_n") > 0)
    return wide.select(
        key,
        *columns.values(),
        *[F.round(F.col(columns[a]) - F.col(columns[b]), 2).alias(out) for out, (a, b) in spreads.items()],
        F.when(F.col("_flag") == 1, 1).otherwise(0).alias(flag_out),
    )
