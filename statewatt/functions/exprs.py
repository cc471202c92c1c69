"""Column expressions shared by the operators. All stay JVM-side."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITESPACE = " \t\n\r\f\x0b"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_non_finite(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Replace NaN and both infinities by NULL in float and double columns."""
    wanted = None if cols is None else set(cols)
    fixes = {}
    for field in df.schema.fields:
        if wanted is not None and field.name not in wanted:
            continue
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            c = F.col(f"`{field.name}`")
            finite = ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
            fixes[field.name] = F.when(finite, c)
    return df.withColumns(fixes) if fixes else df


#: Days by which the year of a partition may differ from a reader's: sessions in
#: other zones see an instant up to 26 hours apart.
_ZONES = dt.timedelta(days=2)


def since(ts: Column | str, first_day: dt.date | str, year: Column | str | None = None) -> Column:
    """Inclusive lower time bound, in a form that reaches the parquet scan.

    ``year`` is the column by whose values a table of ``write_table(year_of=ts)`` is
    partitioned; with it, folders of earlier years are not listed for reading.
    """
    day = dt.date.fromisoformat(first_day) if isinstance(first_day, str) else first_day
    bound = _col(ts) >= F.lit(day)
    return bound if year is None else bound & (_col(year) >= F.lit((day - _ZONES).year))


def in_years(ts: Column | str, first: int, last: int | None = None, year: Column | str | None = None) -> Column:
    """``year(ts) BETWEEN first AND last`` as a half-open range.

    ``year()`` hides the column from the scan; a plain range is pushed down.
    ``year`` is as in ``since``.
    """
    last = first if last is None else last
    end = dt.date(last + 1, 1, 1)
    bound = since(ts, dt.date(first, 1, 1), year) & (_col(ts) < F.lit(end))
    return bound if year is None else bound & (_col(year) <= F.lit((end + _ZONES).year))


def year_column(df: DataFrame, ts: str) -> str | None:
    """The partition column that ``load_table(year_of=ts)`` kept, if ``df`` has it."""
    name = f"{ts}_year"
    return name if name in df.columns else None


def month_period(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def ratio(num: Column | str, den: Column | str) -> Column:
    """Division that yields NULL for a zero or NULL denominator."""
    return F.try_divide(_col(num), _col(den))


def class_sum(cls: Column | str, classes: Sequence[str], val: Column | str) -> Column:
    """Sum of ``val`` over rows whose class is listed; other rows count 0."""
    v = _col(val)
    return F.sum(F.when(_col(cls).isin(list(classes)), v).otherwise(F.lit(0)))


def indicator_count(conditions: Sequence[Column]) -> Column:
    """How many of the conditions hold in a row."""
    total = F.lit(0)
    for condition in conditions:
        total = total + F.when(condition, F.lit(1)).otherwise(F.lit(0))
    return total


def rule_class(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Ordered rules: the first that holds gives the value, else ``default``."""
    if not rules:
        raise ValueError("rule_class needs at least one rule")
    condition, value = rules[0]
    chain = F.when(condition, value)
    for condition, value in rules[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(F.lit(default))


def value_map(key: Column | str, mapping: Mapping[str, object], default: object = None) -> Column:
    """Look a key up in a small fixed mapping."""
    c = _col(key)
    return rule_class([(c == F.lit(k), v) for k, v in mapping.items()], default)


def normalised_text(c: Column | str) -> Column:
    """Upper case without surrounding whitespace."""
    return F.btrim(F.upper(_col(c)), F.lit(WHITESPACE))


def token_sorted(c: Column | str) -> Column:
    """Whitespace-separated tokens in sorted order, joined by one space."""
    tokens = F.filter(F.split(_col(c), r"\s+"), lambda t: t != F.lit(""))
    return F.array_join(F.array_sort(tokens), " ")
