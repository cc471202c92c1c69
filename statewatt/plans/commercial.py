"""Commercial and industrial market, and data-center growth and constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statewatt.functions import composite_score, constraint_points, in_years, rule_class, value_map
from statewatt.operators import apply_overrides, having_semi, market_base, ntile_scores
from statewatt.plans import config as c

DIMENSIONS = [
    "ci_price_score",
    "ci_market_size_score",
    "ci_consumption_score",
    "reliability_score",
    "ci_access_score",
    "dc_opportunity_score",
]


def growth_flag() -> Column:
    """High, Medium or Low from investment, construction and flag counts."""

    def known(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    flags = known("dc_grid_constraint_flag") + known("dc_fossil_delay_flag") + known("dc_onsite_gen_flag")
    invested, building = known("dc_announced_investment_usd_b"), known("dc_under_construction_mw")
    high = (invested >= c.HIGH_INVESTMENT) | (building >= c.HIGH_CONSTRUCTION_MW) | (flags >= c.HIGH_FLAGS)
    medium = invested.between(*c.MEDIUM_INVESTMENT) | (flags == c.MEDIUM_FLAGS)
    return rule_class([(high, "High"), (medium, "Medium")], "Low")


def data_center_score(metrics: DataFrame, structure: DataFrame, overrides: DataFrame) -> DataFrame:
    points = constraint_points(
        "dc_twh_per_year", c.MIN_LOAD_TWH, c.CONSTRAINT_WEIGHTS, value_map("iso_rto", c.OPERATOR_POINTS, 0)
    )
    base = metrics.join(structure.select("state", "iso_rto"), "state")
    base = base.withColumns({"dc_growth_flag": growth_flag(), "constraint_raw": points})
    scores = {
        "dc_capacity_score": "dc_twh_per_year",
        "dc_facilities_score": "dc_facilities",
        "dc_power_constraint_score": "constraint_raw",
    }
    ranked = ntile_scores(base, scores, tie=["state"])
    ranked = ranked.withColumn("dc_composite_score", composite_score(list(scores)))
    out = ranked.drop("iso_rto", "constraint_raw", "dc_under_construction_mw")
    return apply_overrides(out, overrides, "state", "dc_growth_flag")


def business_market(sales: DataFrame, scored: DataFrame) -> DataFrame:
    rows = sales.filter(in_years("report_date", c.REPORT_YEAR) & (F.col("state") != c.COUNTRY_ROW))
    sums, ratios = {}, {}
    for name, classes in (("commercial", ["commercial"]), ("industrial", ["industrial"]), ("ci", c.BUSINESS_CLASSES)):
        sums |= {
            f"{name}_customers": ("customers", classes),
            f"{name}_mwh": ("sales_mwh", classes),
            f"{name}_revenue": ("sales_revenue", classes),
        }
        ratios |= {
            f"avg_{name}_price_per_mwh": (f"{name}_revenue", f"{name}_mwh"),
            f"avg_mwh_per_{name}_customer": (f"{name}_mwh", f"{name}_customers"),
        }
    return market_base(having_semi(rows, "state", scored), "state", sums, ratios, "customer_class")


def business_score(market: DataFrame, scores: DataFrame, structure: DataFrame, centers: DataFrame) -> DataFrame:
    access = rule_class([(F.col("ci_choice_pct") >= bound, v) for bound, v in c.CHOICE_ACCESS], c.CHOICE_ACCESS_DEFAULT)
    joined = (
        market.join(scores.select("state", "reliability_score"), "state")
        .join(structure.select("state", access.alias("ci_access_score")), "state")
        .join(centers.select("state", F.col("dc_composite_score").alias("dc_opportunity_score")), "state")
    )
    ranked = ntile_scores(
        joined,
        {
            "ci_price_score": "avg_ci_price_per_mwh",
            "ci_market_size_score": "ci_customers",
            "ci_consumption_score": "avg_mwh_per_ci_customer",
        },
        tie=["state"],
    )
    return ranked.select(
        "state",
        "ci_customers",
        "avg_ci_price_per_mwh",
        "avg_mwh_per_ci_customer",
        "commercial_customers",
        "industrial_customers",
        *DIMENSIONS,
        composite_score(DIMENSIONS, nulls="propagate").alias("ci_composite_score"),
    )
