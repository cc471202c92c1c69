"""Composite scores in exact decimal arithmetic, and the two report rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SCORE_TYPE = "decimal(14,4)"


def composite_total(dims: Sequence[str], nulls: str = "zero") -> Column:
    """Sum of score columns. ``nulls='zero'`` counts a missing score as 0,
    ``nulls='propagate'`` makes the sum NULL."""
    if nulls not in ("zero", "propagate"):
        raise ValueError(f"nulls must be 'zero' or 'propagate', not {nulls!r}")
    parts = [F.col(d).cast(SCORE_TYPE) for d in dims]
    if nulls == "zero":
        parts = [F.coalesce(p, F.lit(Decimal(0)).cast(SCORE_TYPE)) for p in parts]
    return reduce(lambda a, b: a + b, parts)


def composite_score(dims: Sequence[str], divisor: int | None = None, nulls: str = "zero") -> Column:
    """Score sum over a fixed divisor, rounded half away from zero to 2 places.

    The divisor is a decimal literal: a Python float would turn the quotient
    into a double and move ties.
    """
    by = Decimal(divisor if divisor is not None else len(dims)).quantize(Decimal("0.1"))
    return F.round(composite_total(dims, nulls) / F.lit(by), 2)


def constraint_points(load: str, min_load: float, weights: Mapping[str, int], extra: Column) -> Column:
    """Weighted 0/1 flags plus extra points; 0 below the minimum load.

    Missing flags count 0. A missing load is not below the minimum.
    """
    points = extra
    for flag, weight in weights.items():
        points = points + F.coalesce(F.col(flag), F.lit(0)) * F.lit(weight)
    return F.when(F.col(load) < F.lit(min_load), F.lit(0)).otherwise(points)


def access_gap_flag(structure: str, access: str, min_gap: float) -> Column:
    """True where the formal market score exceeds practical access by at least
    ``min_gap``. The threshold is not published, so it must be given."""
    return (F.col(structure) - F.col(access)) >= F.lit(min_gap)


def signal_tier(score: str, thresholds: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the highest threshold reached; thresholds differ per composite."""
    ordered = sorted(thresholds, key=lambda t: t[0], reverse=True)
    chain = F.when(F.col(score).isNull(), F.lit(None).cast("string"))
    for bound, label in ordered:
        chain = chain.when(F.col(score) >= F.lit(bound), F.lit(label))
    return chain.otherwise(F.lit(default))
