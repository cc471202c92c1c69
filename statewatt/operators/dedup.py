"""Distinct pairs, first row per id, collapsed ids and top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_mapping(df: DataFrame, required: str, *others: str) -> DataFrame:
    """Distinct (required, others) rows where the required column is known."""
    return df.filter(F.col(required).isNotNull()).select(required, *others).distinct()


def dedup_first(df: DataFrame, id_col: str, order: Sequence[str]) -> DataFrame:
    """One row per id, the first by ``order``; NULL ids form one group.

    An aggregate rather than a window: a repeated id shrinks before the
    shuffle however often it occurs.
    """
    others = [c for c in df.columns if c != id_col]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("_row")
    kept = df.groupBy(id_col).agg(first)
    return kept.select(id_col, *[F.col("_row")[c].alias(c) for c in others]).select(*df.columns)


def dedup_collapse(df: DataFrame, id_col: str, first: Sequence[str], sums: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per known id: first known value of some columns, sums of others
    (0 where nothing is known)."""

    def first_known(c: str) -> Column:
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c)

    return (
        df.filter(F.col(id_col).isNotNull())
        .groupBy(id_col)
        .agg(*[first_known(c) for c in first], *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])
    )


def top_k(df: DataFrame, col: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The k largest rows; equal values in ``tie`` order."""
    return df.orderBy(F.col(col).desc_nulls_last(), *tie).limit(k)
