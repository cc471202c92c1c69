from statewatt.operators.dedup import dedup_collapse, dedup_first, distinct_mapping, top_k
from statewatt.operators.fuzzy import attach_matches, fuzzy_best_match, match_report
from statewatt.operators.geo import normalise_crs, polygon_cells, spatial_join, territory_rollup
from statewatt.operators.lookup import apply_overrides, lookup_update, require_unique
from statewatt.operators.market import (
    class_share,
    dim_join_rollup,
    flag_activation,
    having_semi,
    m2m_left_sums,
    market_base,
    weighted_reliability,
)
from statewatt.operators.ramps import Ramp, ramp_metrics
from statewatt.operators.ranking import ntile_score, ntile_scores, ntile_tables, rank_global
from statewatt.operators.rollup import (
    Profile,
    category_shares,
    category_spread,
    concentration,
    cost_stats,
    monthly_rollup,
    normalised_cost,
    period_shift,
    series_profile,
    volume_weighted_price,
    weighted_rollup,
)

__all__ = [
    "Profile",
    "Ramp",
    "apply_overrides",
    "attach_matches",
    "category_shares",
    "category_spread",
    "class_share",
    "concentration",
    "cost_stats",
    "dedup_collapse",
    "dedup_first",
    "dim_join_rollup",
    "distinct_mapping",
    "flag_activation",
    "fuzzy_best_match",
    "having_semi",
    "lookup_update",
    "m2m_left_sums",
    "market_base",
    "match_report",
    "monthly_rollup",
    "normalise_crs",
    "normalised_cost",
    "ntile_score",
    "ntile_scores",
    "ntile_tables",
    "period_shift",
    "polygon_cells",
    "ramp_metrics",
    "rank_global",
    "require_unique",
    "series_profile",
    "spatial_join",
    "territory_rollup",
    "top_k",
    "volume_weighted_price",
    "weighted_reliability",
    "weighted_rollup",
]
