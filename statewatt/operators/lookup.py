"""Row updates from lookup tables, as joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """``df`` with a run-time failure on a repeated key.

    The check is part of the plan: it costs one aggregation of the lookup and
    no extra job.
    """
    others = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct(*others)).alias("_row"))
    message = F.concat(F.lit(f"lookup key {key} repeats: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    checked = F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(message))
    return grouped.select(key, checked.alias("_row")).select(key, *[F.col("_row")[c].alias(c) for c in others])


def lookup_update(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    sets: Mapping[str, Column],
    defaults: Mapping[str, object] | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """Set columns from the lookup row with the same key.

    ``sets`` maps target column -> expression over lookup columns. Unmatched
    rows keep their value, or take ``defaults[target]``, which also replaces a
    NULL result on matched rows. The lookup key must be unique, so the row
    count cannot change; pass ``check_unique=False`` only for a lookup grouped
    by that key. The target's type is kept and a value that does not fit it
    fails.
    """
    defaults = defaults or {}
    picked = lookup.filter(F.col(key).isNotNull()).select(key, *[e.alias(f"_set_{t}") for t, e in sets.items()])
    if check_unique:
        picked = require_unique(picked, key)
    picked = picked.withColumn("_hit", F.lit(True))
    joined = df.join(picked, key, "left")
    types = {f.name: f.dataType for f in df.schema.fields}
    updated = {}
    for target in sets:
        new = F.col(f"_set_{target}")
        if target in types:
            new = new.cast(types[target])
        if target in defaults:
            fallback = F.lit(defaults[target])
            updated[target] = F.coalesce(new, fallback.cast(types[target]) if target in types else fallback)
        elif target in types:
            updated[target] = F.when(F.col("_hit"), new).otherwise(F.col(target))
        else:
            updated[target] = new
    order = [*df.columns, *[t for t in sets if t not in types]]
    return joined.withColumns(updated).select(*order)


def apply_overrides(df: DataFrame, overrides: DataFrame, key: str, target: str, order: str | None = None) -> DataFrame:
    """Replace ``target`` for the keys listed in ``overrides(key, target)``.

    With ``order``, a key may be listed several times and the last one wins.
    """
    fixes = overrides.select(key, F.col(target).alias("_fix"), *([order] if order else []))
    if order:
        fixes = fixes.groupBy(key).agg(F.max_by("_fix", order).alias("_fix"))
    return lookup_update(df, fixes, key, {target: F.col("_fix")})
