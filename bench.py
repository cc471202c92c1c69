"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is planned and run to the end (all columns, no result collected)
twice; the second run is reported, so JVM start-up and code generation are out
of the numbers while all reading, shuffling and checkpointing is in them.
"""

from __future__ import annotations

import json
import os
import re
import time

from statewatt.catalog import QUERIES
from statewatt.session import local_session

HEADLINE = [
    "ramp_pop",
    "ramp_samp",
    "series_profile",
    "gap_profile",
    "fanout_monthly",
    "category_shares",
    "hhi_concentration",
    "weighted_rollup",
    "vw_price",
    "normalised_cost_stats",
    "category_spread",
    "period_shift",
    "m2m_left_sums",
    "distinct_dim_join",
    "weighted_reliability",
    "class_share",
    "flag_activation",
    "market_base",
    "ntile_score",
    "composite_rank",
    "lookup_update",
    "dedup_first",
    "spatial_join_within",
    "fuzzy_best_match",
    "module_a_base",
    "module_a2_state_hourly_metrics",
    "module_b_metrics",
    "integration_final_grid",
    "integration_final_residential",
    "integration_final_ci",
    "dc_in_coop_territory_deduped",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)$", folder.rstrip("/"))
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
