"""State scores over all dimensions and the three final tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statewatt.functions import composite_score, composite_total, rule_class
from statewatt.operators import lookup_update, ntile_tables, rank_global
from statewatt.plans import config as c
from statewatt.plans.grid import FUEL

SCORE = "decimal(3,1)"

GRID_DIMENSIONS = [
    "grid_stress_score",
    "cost_volatility_score",
    "fossil_dependency_score",
    "fossil_backup_dependency_score",
    "transition_opportunity_score",
    "market_structure_score",
    "industrial_load_score",
    "storage_deployment_score",
    "reliability_score",
    "regulatory_receptiveness_score",
    "incentive_score",
]


def base_table(state_hourly: DataFrame, monthly: DataFrame, metrics: DataFrame, spread: DataFrame, summary: DataFrame) -> DataFrame:
    """One row per state with the measures the scores rank."""
    shares = monthly.groupBy("state").agg(
        *[F.max(s).alias(s) for s in ("fossil_share", "renewable_share", "variable_renewable_share")]
    )

    def of_fuel(fuel: str, **cols: str) -> DataFrame:
        return metrics.filter(F.col(FUEL) == fuel).select("state", *[F.col(src).alias(out) for out, src in cols.items()])

    gas = of_fuel("gas", gas_avg_cost_per_mwh="avg_cost_per_mwh", gas_cv_cost="cv_cost", gas_high_null_flag="high_null_flag")
    oil = of_fuel("oil", oil_avg_cost_per_mwh="avg_cost_per_mwh", oil_cv_cost="cv_cost")
    return (
        state_hourly.select(
            "state",
            "cv_gen",
            "cv_demand",
            "avg_ramp_rate_mwh",
            "max_ramp_rate_mwh",
            "avg_demand_ramp_mwh",
            "max_demand_ramp_mwh",
            "avg_interchange_mwh",
            "max_deficit_mwh",
        )
        .join(shares, "state")
        .join(gas, "state", "left")
        .join(oil, "state", "left")
        .join(spread.select("state", "gas_coal_spread", "oil_coal_spread"), "state", "left")
        .join(
            summary.select(
                "state",
                "hhi_concentration",
                "dominant_fuel_type",
                "dominant_fuel_pct",
                "variable_re_growth_pct",
                "late_fossil_pct",
                "late_variable_re_pct",
                "transition_status",
                "concentration_class",
            ),
            "state",
        )
        .withColumns(
            {
                "market_structure": F.lit(None).cast("string"),
                "iso_rto": F.lit(None).cast("string"),
                "industrial_load_score": F.lit(None).cast("int"),
                "incentive_score": F.lit(None).cast(SCORE),
            }
        )
    )


def market_structure_score() -> Column:
    operator, structure = F.col("iso_rto"), F.col("market_structure")
    central, points = c.CENTRAL_MARKET
    rules = [(operator == central, points)]
    for kind, organised, value in c.MARKET_STRUCTURE_SCORES:
        placed = operator != c.NO_MARKET_OPERATOR if organised else operator == c.NO_MARKET_OPERATOR
        rules.append(((structure == kind) & placed, value))
    return rule_class(rules, c.MARKET_STRUCTURE_DEFAULT)


def score_table(
    base: DataFrame,
    structure: DataFrame,
    industrial: DataFrame,
    storage: DataFrame,
    reliable: DataFrame,
    receptive: DataFrame,
    incentives: DataFrame,
) -> DataFrame:
    """Quintile scores per dimension.

    Measures of the base table are ranked among its states, those of a lookup
    among all states it lists; one sort ranks them all and one join brings the
    buckets to the base table, whose states must be unique.
    """
    ranks = {
        "_cv_gen": "cv_gen",
        "_cv_demand": "cv_demand",
        "_ramp": "avg_ramp_rate_mwh",
        "_demand_ramp": "avg_demand_ramp_mwh",
        "cost_volatility_score": "gas_cv_cost",
        "_fossil": "fossil_share",
        "_hhi": "hhi_concentration",
        "_late_fossil": "late_fossil_pct",
        "_growth": "variable_re_growth_pct",
        "_late_renewable": "late_variable_re_pct",
    }
    lookups = {
        "industrial_load_score": (industrial, "industrial_pct"),
        "storage_deployment_score": (storage, "total_discharge_mw"),
        "reliability_score": (reliable, "saidi_weighted_avg"),
        "regulatory_receptiveness_score": (receptive, "ee_savings_mwh"),
    }
    tables = [(base, ranks), *[(t.select("state", measure), {out: measure}) for out, (t, measure) in lookups.items()]]
    ranked = base.drop(*lookups).join(ntile_tables(tables, "state"), "state", "left")
    ranked = ranked.withColumn("storage_deployment_score", F.coalesce("storage_deployment_score", F.lit(1)))
    blends = {
        "grid_stress_score": ["_cv_gen", "_cv_demand", "_ramp", "_demand_ramp"],
        "fossil_dependency_score": ["_fossil", "_hhi"],
        "fossil_backup_dependency_score": ["_late_fossil", "_growth", "cost_volatility_score"],
        "transition_opportunity_score": ["_growth", "_late_renewable"],
    }
    scores = ranked.select(
        "state",
        "dominant_fuel_type",
        "transition_status",
        "concentration_class",
        "gas_high_null_flag",
        "cv_gen",
        "cv_demand",
        "avg_ramp_rate_mwh",
        "gas_cv_cost",
        "gas_avg_cost_per_mwh",
        "oil_avg_cost_per_mwh",
        "oil_coal_spread",
        "gas_coal_spread",
        "hhi_concentration",
        "fossil_share",
        "variable_re_growth_pct",
        "late_fossil_pct",
        "late_variable_re_pct",
        "cost_volatility_score",
        *[composite_score(dims).alias(out) for out, dims in blends.items()],
        *[(F.col(s) if s in lookups else F.lit(None)).cast(SCORE).alias(s) for s in GRID_DIMENSIONS[5:]],
    )

    scores = lookup_update(scores, structure, "state", {"market_structure_score": market_structure_score()})
    offered = incentives.select("state", F.col("incentive_score").alias("offered"))
    return lookup_update(scores, offered, "state", {"incentive_score": F.col("offered")})


def final_grid(scores: DataFrame) -> DataFrame:
    """Ranked by the unrounded total, so equal rounded scores may differ in rank."""
    ranked = rank_global(scores.withColumn("_total", composite_total(GRID_DIMENSIONS)), "_total", "opportunity_rank")
    return ranked.select(
        "state",
        "dominant_fuel_type",
        "transition_status",
        "concentration_class",
        "gas_high_null_flag",
        *[F.round(d, 2).alias(d) for d in GRID_DIMENSIONS],
        composite_score(GRID_DIMENSIONS).alias("composite_score"),
        "opportunity_rank",
    )


def final_residential(residential: DataFrame, scores: DataFrame) -> DataFrame:
    access, wholesale = F.col("residential_access_score"), F.col("wholesale_complexity_score")
    model = rule_class(
        [
            ((access >= 4) & (wholesale >= 3), c.RETAIL_DIRECT),
            ((access >= 3) & (wholesale >= 3), c.RETAIL_LIMITED),
            (access == 2, c.RETAIL_PARTNERSHIP),
        ],
        c.UTILITY_ONLY,
    )
    kept = residential.join(scores.select("state"), "state", "left_semi")
    ranked = rank_global(kept, "residential_composite_score", "opportunity_rank")
    return ranked.drop("residential_mwh").withColumn("business_model", model)


def final_business(business: DataFrame, centers: DataFrame) -> DataFrame:
    center, access = F.col("dc_opportunity_score"), F.col("ci_access_score")
    model = rule_class(
        [
            ((center >= 4) & (access >= 3), c.BUSINESS_AND_CENTERS),
            ((center >= 4) & (access < 3), c.CENTERS),
            ((center < 4) & (access >= 3), c.BUSINESS_DIRECT),
            ((center < 4) & (access < 3) & (F.col("dc_growth_flag") == "High"), c.CENTER_PIPELINE),
        ],
        c.UTILITY_ONLY,
    )
    joined = business.join(centers.select("state", "dc_growth_flag"), "state")
    return rank_global(joined, "ci_composite_score", "opportunity_rank").withColumn("business_model", model)
