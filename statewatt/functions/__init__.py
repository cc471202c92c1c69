from statewatt.functions.exprs import (
    class_sum,
    clean_non_finite,
    in_years,
    indicator_count,
    month_period,
    normalised_text,
    ratio,
    rule_class,
    since,
    token_sorted,
    value_map,
    year_column,
)
from statewatt.functions.scores import access_gap_flag, composite_score, composite_total, constraint_points, signal_tier

__all__ = [
    "access_gap_flag",
    "class_sum",
    "clean_non_finite",
    "composite_score",
    "composite_total",
    "constraint_points",
    "in_years",
    "indicator_count",
    "month_period",
    "normalised_text",
    "ratio",
    "rule_class",
    "signal_tier",
    "since",
    "token_sorted",
    "value_map",
    "year_column",
]
