"""Declared schemas of the inputs; only the columns the models read."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "score": T.DecimalType(5, 2),
}


def _schema(columns: str) -> T.StructType:
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, T.StructType] = {
    "out_eia923__monthly_generation_fuel_combined": _schema(
        "plant_id_eia bigint, report_date date, fuel_type_code_pudl string, net_generation_mwh double"
    ),
    "out_eia__monthly_generators": _schema(
        "plant_id_eia bigint, report_date date, state string, fuel_type_code_pudl string, "
        "capacity_factor double, balancing_authority_code_eia string"
    ),
    "out_eia930__hourly_operations": _schema(
        "balancing_authority_code_eia string, datetime_utc timestamp, net_generation_imputed_eia_mwh double, "
        "demand_imputed_pudl_mwh double, interchange_adjusted_mwh double"
    ),
    "out_eia923__monthly_fuel_receipts_costs": _schema(
        "state string, fuel_type_code_pudl string, report_date date, total_fuel_cost double, "
        "fuel_consumed_mmbtu double, fuel_cost_per_mmbtu double"
    ),
    "raw_eia861__yearly_sales": _schema(
        "state string, report_date date, customer_class string, entity_type string, customers double, "
        "sales_mwh double, sales_revenue double"
    ),
    "raw_eia861__yearly_reliability": _schema(
        "state string, report_date date, standard string, saidi_wo_major_event_days_minutes double, customers double"
    ),
    "raw_eia861__yearly_energy_efficiency": _schema(
        "utility_id_eia bigint, state string, report_date date, incremental_energy_savings_mwh double, "
        "incremental_peak_reduction_mw double"
    ),
    "raw_eia861__yearly_demand_response": _schema(
        "utility_id_eia bigint, state string, report_date date, actual_peak_demand_savings_mw double, "
        "energy_savings_mwh double"
    ),
    "raw_eia860__storage_generators": _schema(
        "plant_id_eia bigint, report_date date, max_discharge_rate_mw double, served_arbitrage boolean, "
        "served_frequency_regulation boolean, served_system_peak_shaving boolean, served_backup_power boolean, "
        "served_ramping_spinning_reserve boolean"
    ),
    "raw_dc_metrics": _schema(
        "state string, dc_facilities bigint, dc_twh_per_year double, dc_inventory_mw double, "
        "dc_announced_investment_usd_b double, dc_under_construction_mw double, dc_grid_constraint_flag int, "
        "dc_fossil_delay_flag int, dc_onsite_gen_flag int, major_hubs string, major_operators string"
    ),
    "market_structure_ref": _schema("state string, iso_rto string, market_structure string, ci_choice_pct double"),
    "raw_dsire_incentive_scores": _schema("state string, incentive_score score"),
    "growth_overrides": _schema("state string, dc_growth_flag string"),
    "data_center_atlas": _schema("id string, lat double, lon double, sqft double"),
    "cooperative_utilities": _schema("utility_id_eia bigint, utility_name_eia string, state string"),
}

GEO_PROPERTIES = _schema("TYPE string, NAME string, STATE string")
