"""Fuel cost: monthly prices, cost per mwh, statistics and spreads."""

from __future__ import annotations

from pyspark.sql import DataFrame

from statewatt.operators import category_spread, cost_stats, normalised_cost, volume_weighted_price
from statewatt.plans import config as c
from statewatt.plans.grid import FUEL


def price_base(receipts: DataFrame) -> DataFrame:
    names = {
        "price": "avg_cost_per_mmbtu",
        "min": "min_cost_per_mmbtu",
        "max": "max_cost_per_mmbtu",
        "volume": "total_fuel_consumed_mmbtu",
        "cost": "total_fuel_cost",
        "nulls": "null_cost_count",
    }
    return volume_weighted_price(
        receipts,
        ["state", FUEL],
        "report_date",
        "total_fuel_cost",
        "fuel_consumed_mmbtu",
        "fuel_cost_per_mmbtu",
        names,
        c.FIRST_DAY,
    )


def cost_per_mwh(base: DataFrame) -> DataFrame:
    return normalised_cost(
        base, FUEL, "avg_cost_per_mmbtu", c.HEAT_RATES, "record_count", "null_cost_count", "benchmark_heat_rate", "est_cost_per_mwh"
    )


def cost_metrics(costs: DataFrame) -> DataFrame:
    names = {
        "avg": "avg_cost_per_mwh",
        "min": "min_cost_per_mwh",
        "max": "max_cost_per_mwh",
        "stddev": "std_dev_cost_per_mwh",
        "range": "cost_range_per_mwh",
    }
    return cost_stats(costs, ["state", FUEL], "est_cost_per_mwh", "null_pct", c.HIGH_NULL_PCT, names)


def cost_spread(metrics: DataFrame) -> DataFrame:
    return category_spread(
        metrics,
        "state",
        FUEL,
        "avg_cost_per_mwh",
        "high_null_flag",
        {fuel: f"{fuel}_avg_cost_per_mwh" for fuel in ("gas", "coal", "oil")},
        {"gas_coal_spread": ("gas", "coal"), "gas_oil_spread": ("gas", "oil"), "oil_coal_spread": ("oil", "coal")},
        base="gas",
        flag_out="any_high_null_flag",
    )
