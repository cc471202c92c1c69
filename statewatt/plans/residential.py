"""Residential market size, price and access."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewatt.functions import composite_score, in_years, rule_class
from statewatt.operators import market_base, ntile_scores
from statewatt.plans import config as c

DIMENSIONS = [
    "residential_price_score",
    "residential_market_size_score",
    "residential_consumption_score",
    "reliability_score",
    "market_structure_score",
    "residential_access_score",
    "wholesale_complexity_score",
]


def structure_with_access(structure: DataFrame) -> DataFrame:
    """Market reference rows with the two scores the residential model adds."""
    state, operator = F.col("state"), F.col("iso_rto")
    return structure.withColumns(
        {
            "residential_access_score": rule_class(
                [(state.isin(s), v) for s, v in c.RESIDENTIAL_ACCESS], c.RESIDENTIAL_ACCESS_DEFAULT
            ),
            "wholesale_complexity_score": rule_class(
                [(operator.isin(o), v) for o, v in c.WHOLESALE_COMPLEXITY], c.WHOLESALE_COMPLEXITY_DEFAULT
            ),
        }
    )


def residential_market(sales: DataFrame) -> DataFrame:
    rows = sales.filter(
        in_years("report_date", c.REPORT_YEAR)
        & (F.col("customer_class") == "residential")
        & ~F.col("state").isin(c.NON_CONTIGUOUS)
    )
    sums = {
        "residential_customers": ("customers", None),
        "residential_mwh": ("sales_mwh", None),
        "residential_revenue": ("sales_revenue", None),
    }
    ratios = {
        "avg_retail_price_per_mwh": ("residential_revenue", "residential_mwh"),
        "avg_mwh_per_customer": ("residential_mwh", "residential_customers"),
    }
    base = market_base(rows, "state", sums, ratios, "customer_class", positive_only=False)
    return base.withColumns({x: F.round(x, 0) for x in sums} | {x: F.round(x, 2) for x in ratios})


def residential_score(market: DataFrame, scores: DataFrame, structure: DataFrame) -> DataFrame:
    """Ranks are taken over the states that survive the joins."""
    joined = market.join(scores.select("state", "reliability_score", "market_structure_score"), "state").join(
        structure.select("state", "residential_access_score", "wholesale_complexity_score"), "state"
    )
    ranked = ntile_scores(
        joined,
        {
            "residential_price_score": "avg_retail_price_per_mwh",
            "residential_market_size_score": "residential_customers",
            "residential_consumption_score": "avg_mwh_per_customer",
        },
        tie=["state"],
    )
    return ranked.select(
        "state",
        "residential_customers",
        "avg_retail_price_per_mwh",
        "avg_mwh_per_customer",
        "residential_mwh",
        *DIMENSIONS,
        composite_score(DIMENSIONS, nulls="propagate").alias("residential_composite_score"),
    )
