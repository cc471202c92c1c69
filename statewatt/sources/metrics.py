"""Run counters collected while a plan runs, without an extra pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` plus an observation with ``rows`` and the given aggregates,
    readable after the first action on the returned frame."""
    watch = Observation(name)
    cols = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]]
    return df.observe(watch, *cols), watch
