"""Absolute step-to-step change of series, per key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _chunk(df: DataFrame, ts: str, unit: str) -> Column:
    """Start or number of the time chunk a row falls in, in time order.

    Zone-less timestamps are cut by their own fields: a detour through the
    session zone could reorder chunks around a clock change.
    """
    c = F.col(ts)
    if not isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.date_trunc(unit, c)
    day = c.cast("date")
    if unit in ("hour", "minute"):
        number = F.unix_date(day) * F.lit(24) + F.hour(c)
        return number if unit == "hour" else number.cast("long") * F.lit(60) + F.minute(c)
    return day if unit == "day" else F.trunc(day, unit)


@dataclass(frozen=True)
class Ramp:
    """One series and the output names of its ramp statistics.

    ``ddof`` is 0 for the population and 1 for the sample deviation.
    """

    value: str
    avg: str
    max: str
    stddev: str
    ddof: int = 0

    def __post_init__(self) -> None:
        if self.ddof not in (0, 1):
            raise ValueError("ddof must be 0 or 1")


def ramp_metrics(
    df: DataFrame,
    key: str,
    ts: str,
    ramps: Sequence[Ramp],
    tie: Sequence[str] = (),
    chunk: str = "month",
    drop_first: bool = True,
    max_gap: dt.timedelta | None = None,
) -> DataFrame:
    """Mean, maximum and deviation of |x(t) - x(t-1)| per key, in time order.

    "Previous" is the previous row, so a missing hour is bridged and a NULL
    value breaks the two pairs it takes part in. With ``max_gap`` a row more than
    that after the previous one has no previous value, and so has a row next to
    one without a time. ``drop_first=True`` keeps
    keys (the NULL key too) with at least one row whose previous value is
    known; ``False`` keeps every non-NULL key.

    Every key is windowed per time ``chunk`` (minute, hour, day, week, month,
    quarter or year), so its history spreads over as many tasks as it has
    chunks; choose one that holds many rows, such as a month of hourly data.
    Each chunk leaves its moments and its first and last value; the step between
    chunks is added from those, and moments are merged around the key's mean.
    """
    order = [F.col(ts), *[F.col(t) for t in tie]]
    w = Window.partitionBy(key, "_chunk").orderBy(*order)
    steps = df.select(key, ts, *tie, *dict.fromkeys(r.value for r in ramps))
    steps = steps.withColumn("_chunk", _chunk(df, ts, chunk))

    def near(end: Column, start: Column | str, value: Column) -> Column:
        return value if max_gap is None else F.when(F.col(start) - end <= F.lit(max_gap), value)

    seen: dict[str, Column] = {f"_p{i}": near(F.lag(ts).over(w), ts, F.lag(r.value).over(w)) for i, r in enumerate(ramps)}
    seen |= {"_first": F.row_number().over(w) == 1, "_last": F.lead(F.lit(True)).over(w).isNull()}
    steps = steps.withColumns(seen)

    aggs: list[Column] = [] if max_gap is None else [F.min(ts).alias("_from"), F.max(ts).alias("_to")]
    for i, r in enumerate(ramps):
        prev, d = F.col(f"_p{i}"), F.abs(F.col(r.value) - F.col(f"_p{i}"))
        aggs += [
            F.count(d).alias(f"_n{i}"),
            F.sum(d).alias(f"_s{i}"),
            (F.var_pop(d) * F.count(d)).alias(f"_v{i}"),
            F.max(d).alias(f"_x{i}"),
            F.count(prev).alias(f"_k{i}"),
            F.max(F.when(F.col("_first"), F.col(r.value))).alias(f"_f{i}"),
            F.max(F.when(F.col("_last"), F.col(r.value))).alias(f"_l{i}"),
        ]
    chunks = steps.groupBy(key, "_chunk").agg(*aggs)

    in_order = Window.partitionBy(key).orderBy("_chunk")
    whole = Window.partitionBy(key)
    joins = {f"_j{i}": near(F.lag("_to").over(in_order), "_from", F.lag(f"_l{i}").over(in_order)) for i in range(len(ramps))}
    chunks = chunks.withColumns(joins)
    chunks = chunks.withColumns({f"_b{i}": F.abs(F.col(f"_f{i}") - F.col(f"_j{i}")) for i in range(len(ramps))})
    zero = F.lit(0.0)
    means = {}
    for i in range(len(ramps)):
        n = F.col(f"_n{i}") + F.col(f"_b{i}").isNotNull().cast("int")
        s = F.coalesce(F.col(f"_s{i}"), zero) + F.coalesce(F.col(f"_b{i}"), zero)
        means[f"_mu{i}"] = F.try_divide(F.sum(s).over(whole), F.sum(n).over(whole))
    chunks = chunks.withColumns(means)

    final: list[Column] = []
    pairs: list[Column] = []
    for i, r in enumerate(ramps):
        b, mu = F.col(f"_b{i}"), F.col(f"_mu{i}")
        n = F.sum(F.col(f"_n{i}") + b.isNotNull().cast("int"))
        spread = F.try_divide(F.col(f"_s{i}"), F.col(f"_n{i}")) - mu
        m2 = F.sum(
            F.coalesce(F.col(f"_v{i}") + F.col(f"_n{i}") * spread * spread, zero) + F.coalesce((b - mu) * (b - mu), zero)
        )
        final += [
            F.max(mu).alias(r.avg),
            F.max(F.greatest(f"_x{i}", f"_b{i}")).alias(r.max),
            F.sqrt(F.when(n > r.ddof, F.try_divide(m2, n - r.ddof))).alias(r.stddev),
        ]
        pairs.append(F.sum(F.col(f"_k{i}") + F.col(f"_j{i}").isNotNull().cast("int")))
    total_pairs = pairs[0]
    for p in pairs[1:]:
        total_pairs = total_pairs + p
    out = chunks.groupBy(key).agg(*final, total_pairs.alias("_pairs"))
    out = out.filter(F.col("_pairs") > 0) if drop_first else out.filter(F.col(key).isNotNull())
    return out.drop("_pairs")
