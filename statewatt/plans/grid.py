"""Grid stress: generation by state and fuel, hourly metrics by area and state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewatt.functions import indicator_count, since, year_column
from statewatt.operators import Profile, Ramp, category_shares, distinct_mapping, monthly_rollup, ramp_metrics, series_profile, weighted_rollup
from statewatt.plans import config as c

FUEL = "fuel_type_code_pudl"
AREA = "balancing_authority_code_eia"
GENERATION, DEMAND, INTERCHANGE = "net_generation_imputed_eia_mwh", "demand_imputed_pudl_mwh", "interchange_adjusted_mwh"

GENERATION_RAMP = Ramp(GENERATION, "avg_ramp_rate_mwh", "max_ramp_rate_mwh", "std_dev_ramp_rate_mwh", ddof=0)
DEMAND_RAMP = Ramp(DEMAND, "avg_demand_ramp_mwh", "max_demand_ramp_mwh", "std_dev_demand_ramp_mwh", ddof=1)
INTERCHANGE_RAMP = Ramp(INTERCHANGE, "avg_interchange_ramp_mwh", "max_interchange_ramp_mwh", "std_dev_interchange_ramp_mwh", ddof=1)


def generation_base(generation: DataFrame, generators: DataFrame, fanout: str = "keep") -> DataFrame:
    return monthly_rollup(
        generation,
        generators,
        ["plant_id_eia", "report_date"],
        ["state"],
        [FUEL],
        "report_date",
        "net_generation_mwh",
        "monthly_gen_mwh",
        c.FIRST_DAY,
        fanout,
    )


def monthly_metrics(base: DataFrame, generators: DataFrame) -> DataFrame:
    stats = Profile(
        F.col("monthly_gen_mwh"),
        {
            "total": "total_gen_mwh",
            "avg": "avg_monthly_gen_mwh",
            "max": "max_monthly_gen_mwh",
            "min": "min_monthly_gen_mwh",
            "stddev": "std_dev_gen_mwh",
            "range": "range_gen_mwh",
            "cv": "coefficient_of_variation",
        },
    )
    groups = {
        "renewable_share": c.RENEWABLE,
        "variable_renewable_share": c.VARIABLE_RENEWABLE,
        "fossil_share": c.FOSSIL,
    }
    volumes = series_profile(base, ["state", FUEL], [stats])
    shares = category_shares(volumes, "state", FUEL, "total_gen_mwh", groups, "fuel_share")
    capacity = (
        generators.filter(since("report_date", c.FIRST_DAY, year_column(generators, "report_date")) & F.col("state").isNotNull())
        .groupBy("state", FUEL)
        .agg(F.avg("capacity_factor").alias("avg_capacity_factor"))
    )
    return shares.join(capacity, ["state", FUEL], "left")


def area_states(generators: DataFrame) -> DataFrame:
    return distinct_mapping(generators, AREA, "state")


def _recent(hourly: DataFrame) -> DataFrame:
    return hourly.filter(since("datetime_utc", c.FIRST_DAY, year_column(hourly, "datetime_utc")))


def generation_ramps(hourly: DataFrame) -> DataFrame:
    return ramp_metrics(_recent(hourly), AREA, "datetime_utc", [GENERATION_RAMP])


def additional_ramps(hourly: DataFrame) -> DataFrame:
    ramps = [DEMAND_RAMP, INTERCHANGE_RAMP]
    return ramp_metrics(_recent(hourly), AREA, "datetime_utc", ramps, drop_first=False)


def hourly_metrics(hourly: DataFrame) -> DataFrame:
    """Hourly profiles and all three ramps per area.

    Hourly rows are aggregated before the ramps are attached, and the three
    ramps share one shuffle of the hourly rows.
    """
    recent = _recent(hourly)

    def named(suffix: str, **others: str) -> dict[str, str]:
        return {
            "avg": f"avg_hourly_{suffix}_mwh",
            "stddev": f"std_dev_{suffix}_mwh",
            "max": f"max_hourly_{suffix}_mwh",
            "min": f"min_hourly_{suffix}_mwh",
            "cv": f"cv_{suffix}",
        } | others

    profiles = [
        Profile(F.col(GENERATION), named("gen", range="range_gen_mwh")),
        Profile(F.col(DEMAND), named("demand")),
        Profile(
            F.col(GENERATION) - F.col(DEMAND),
            named("gap", avg="avg_gap_mwh", max="max_surplus_mwh", min="max_deficit_mwh"),
            cv_base=F.col(DEMAND),
        ),
        Profile(
            F.col(INTERCHANGE),
            named("interchange", avg="avg_interchange_mwh", max="max_interchange_mwh", min="min_interchange_mwh"),
        ),
    ]
    all_ramps = [GENERATION_RAMP, DEMAND_RAMP, INTERCHANGE_RAMP]
    ramps = ramp_metrics(recent, AREA, "datetime_utc", all_ramps, drop_first=False)
    checked = ["avg_hourly_gen_mwh", "avg_hourly_demand_mwh", "avg_gap_mwh", "avg_ramp_rate_mwh", "avg_demand_ramp_mwh"]
    return (
        series_profile(recent, [AREA], profiles)
        .join(ramps, AREA, "left")
        .withColumn("null_count", indicator_count([F.col(x).isNull() for x in checked]))
    )


def state_hourly_metrics(areas: DataFrame, mapping: DataFrame) -> DataFrame:
    """Area metrics weighted by mean generation; an area in several states
    counts whole in each."""
    means = [
        "avg_hourly_gen_mwh",
        "std_dev_gen_mwh",
        "avg_hourly_demand_mwh",
        "std_dev_demand_mwh",
        "avg_gap_mwh",
        "std_dev_gap_mwh",
        "avg_interchange_mwh",
        "std_dev_interchange_mwh",
        "avg_ramp_rate_mwh",
        "std_dev_ramp_rate_mwh",
        "avg_demand_ramp_mwh",
        "std_dev_demand_ramp_mwh",
        "avg_interchange_ramp_mwh",
        "std_dev_interchange_ramp_mwh",
    ]
    maxes = [
        "max_hourly_gen_mwh",
        "max_hourly_demand_mwh",
        "max_surplus_mwh",
        "max_interchange_mwh",
        "max_ramp_rate_mwh",
        "max_demand_ramp_mwh",
        "max_interchange_ramp_mwh",
    ]
    mins = ["min_hourly_gen_mwh", "min_hourly_demand_mwh", "max_deficit_mwh", "min_interchange_mwh", "null_count"]
    return weighted_rollup(
        areas.join(mapping, AREA),
        "state",
        "avg_hourly_gen_mwh",
        means,
        maxes,
        mins,
        {"range_gen_mwh": ("max_hourly_gen_mwh", "min_hourly_gen_mwh")},
        {
            "cv_gen": ("std_dev_gen_mwh", "avg_hourly_gen_mwh"),
            "cv_demand": ("std_dev_demand_mwh", "avg_hourly_demand_mwh"),
            "cv_gap": ("std_dev_gap_mwh", "avg_hourly_demand_mwh"),
        },
    ).withColumnRenamed("null_count", "min_null_count")
