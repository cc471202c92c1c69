"""Industrial load, storage deployment, reliability and policy activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewatt.functions import in_years
from statewatt.operators import class_share, flag_activation, m2m_left_sums, weighted_reliability
from statewatt.plans import config as c


def _contiguous(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("state").isin(c.NON_CONTIGUOUS))


def industrial_load(sales: DataFrame) -> DataFrame:
    return class_share(
        _contiguous(sales.filter(in_years("report_date", c.REPORT_YEAR))),
        "state",
        "customer_class",
        {"sales_mwh": "industrial_pct"},
        ["industrial"],
        c.CUSTOMER_CLASSES,
        2,
        {"sales_mwh": ("industrial_mwh", "total_mwh")},
    )


def storage_deployment(storage: DataFrame, generators: DataFrame) -> DataFrame:
    plants = _contiguous(generators).select("plant_id_eia", "state").distinct()
    units = storage.filter(in_years("report_date", c.REPORT_YEAR)).join(plants, "plant_id_eia")
    flags = {
        "served_arbitrage": "units_arbitrage",
        "served_frequency_regulation": "units_freq_reg",
        "served_system_peak_shaving": "units_peak_shaving",
        "served_backup_power": "units_backup_power",
        "served_ramping_spinning_reserve": "units_spinning_reserve",
    }
    names = {"count": "storage_units", "size": "total_discharge_mw", "total": "total_use_case_activations"}
    return flag_activation(units, "state", flags, "max_discharge_rate_mw", names)


def reliability(interruptions: DataFrame) -> DataFrame:
    return weighted_reliability(
        _contiguous(interruptions.filter(F.col("standard") == "ieee_standard")),
        "state",
        "saidi_wo_major_event_days_minutes",
        "customers",
        "report_date",
        c.RELIABILITY_YEARS,
        {"mean": "saidi_weighted_avg", "weight": "total_customers"},
    )


def regulatory_receptiveness(efficiency: DataFrame, response: DataFrame, fanout: str = "keep") -> DataFrame:
    return m2m_left_sums(
        _contiguous(efficiency.filter(in_years("report_date", c.REPORT_YEAR))),
        response,
        ["state", "report_date", "utility_id_eia"],
        "state",
        {"incremental_energy_savings_mwh": "ee_savings_mwh", "incremental_peak_reduction_mw": "ee_peak_reduction_mw"},
        {"actual_peak_demand_savings_mw": "dr_peak_reduction_mw", "energy_savings_mwh": "dr_savings_mwh"},
        0,
        fanout,
    )


def cooperative_density(sales: DataFrame, reliable: DataFrame) -> DataFrame:
    rows = sales.filter(in_years("report_date", c.REPORT_YEAR) & (F.col("state") != c.COUNTRY_ROW))
    shares = class_share(
        rows,
        "state",
        "entity_type",
        {"customers": "cooperative_customer_pct", "sales_mwh": "cooperative_mwh_pct"},
        ["cooperative"],
        None,
        1,
        having="customers",
    )
    return shares.join(reliable.select("state", "saidi_weighted_avg"), "state")
