"""Query registry and small helpers shared by the catalog modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: Column | str) -> Column:
    """Exact amount, so that a sum does not depend on row order."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def hundredths(c: str) -> Column:
    """A two-place amount in whole hundredths: sums are exact in any order, so
    means agree to the last bit between engines."""
    return F.round(F.col(c) * 100)


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in cols})


def as_double(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def as_long(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in cols})
