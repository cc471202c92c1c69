"""Fuel concentration and the shift towards renewables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewatt.functions import rule_class
from statewatt.operators import concentration, period_shift
from statewatt.plans import config as c
from statewatt.plans.grid import FUEL


def fuel_concentration(monthly: DataFrame) -> DataFrame:
    names = {
        "hhi": "hhi_concentration",
        "count": "fuel_type_count",
        "top_share": "dominant_fuel_share",
        "top": "dominant_fuel_type",
    }
    return concentration(monthly, "state", FUEL, "fuel_share", names)


def renewable_trend(base: DataFrame) -> DataFrame:
    return period_shift(
        base,
        "state",
        F.left("period", F.lit(4)),
        FUEL,
        "monthly_gen_mwh",
        {"variable_re_share": c.VARIABLE_RENEWABLE, "total_re_share": c.RENEWABLE, "fossil_share": c.FOSSIL},
        c.EARLY_YEARS,
        c.LATE_YEARS,
        {"variable_re_share": "variable_re_growth", "total_re_share": "total_re_growth"},
    )


def transition_summary(concentrated: DataFrame, trend: DataFrame) -> DataFrame:
    growth, fossil = F.col("variable_re_growth"), F.col("fossil_share_change")
    hhi = F.col("hhi_concentration")
    status = rule_class(
        [
            ((growth >= c.RAPID_GROWTH) & (fossil < 0), "rapid_transition"),
            ((growth >= c.MODERATE_GROWTH) & (fossil < 0), "moderate_transition"),
            ((growth >= c.MODERATE_GROWTH) & (fossil >= 0), "renewable_adding_not_replacing"),
            ((growth < c.MODERATE_GROWTH) & (fossil < 0), "slow_transition"),
        ],
        "fossil_entrenched",
    )
    kind = rule_class(
        [(hhi >= c.HIGH_CONCENTRATION, "highly_concentrated"), (hhi >= c.MODERATE_CONCENTRATION, "moderately_concentrated")],
        "diversified",
    )
    percentages = {
        "early_variable_re_share": "early_variable_re_pct",
        "late_variable_re_share": "late_variable_re_pct",
        "variable_re_growth": "variable_re_growth_pct",
        "early_total_re_share": "early_total_re_pct",
        "late_total_re_share": "late_total_re_pct",
        "total_re_growth": "total_re_growth_pct",
        "early_fossil_share": "early_fossil_pct",
        "late_fossil_share": "late_fossil_pct",
        "fossil_share_change": "fossil_change_pct",
    }
    # shares rounded to four places are exact as decimals; as doubles, a tenth
    # of them would sit on a rounding tie and follow binary noise
    exact = {pct: F.round(F.col(share).cast("decimal(9,4)") * 100, 1).cast("double") for share, pct in percentages.items()}
    return concentrated.join(trend, "state").select(
        "state",
        "hhi_concentration",
        "fuel_type_count",
        "dominant_fuel_type",
        F.round(F.col("dominant_fuel_share") * 100, 1).alias("dominant_fuel_pct"),
        *[c.alias(pct) for pct, c in exact.items()],
        status.alias("transition_status"),
        kind.alias("concentration_class"),
    )


def fuel_share(monthly: DataFrame) -> DataFrame:
    return monthly.select("state", FUEL, F.round("total_gen_mwh", 0).alias("total_fuel_gen_mwh"), "fuel_share")
