"""The model inputs, derived by Spark from the driver tables.

Nations become states, customers plants, orders monthly output and yearly
sales, line items generators and fuel receipts, events hourly operations.
Dates move 24 years forward so that the models' periods are covered. Amounts
are whole numbers: sums are exact in any order.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statewatt.catalog.registry import hundredths, table
from statewatt.functions import value_map

STATES = ["TX", "OH", "PA", "IL", "NY", "NJ", "MD", "CA", "NV", "OR", "DE", "VA", "WA", "IA", "AK", "US", "MA", "NH", "ME", "CT", "GA", "FL", "CO", "MN", "HI"]
OPERATORS = ["ERCOT", "PJM", "MISO", "NYISO", "ISO_NE", "non_ISO"]
STRUCTURES = ["deregulated", "restricted", "regulated"]
FUELS = {"1-URGENT": "solar", "2-HIGH": "wind", "3-MEDIUM": "gas", "4-NOT SPECIFIED": "coal"}
CLASSES = {"HOUSEHOLD": "residential", "MACHINERY": "industrial", "AUTOMOBILE": "transportation"}
SHIFT_MONTHS = 24 * 12


def _pick(values: list[str], index: Column) -> Column:
    """The listed value at a 0-based index, NULL past the end."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _shifted(c: str, unit: str) -> Column:
    return F.add_months(F.trunc(F.col(c).cast("date"), unit), SHIFT_MONTHS)


def _whole(c: Column | str) -> Column:
    return F.floor(c).cast("double")


class DerivedInputs(Mapping):
    """Input name -> DataFrame over one scale folder, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._table = cache(lambda name: table(spark, sf_dir, name))  # each file's schema is read once

    def __getitem__(self, name: str) -> DataFrame:
        return _BUILDERS[name](self._table)

    def __iter__(self):
        return iter(_BUILDERS)

    def __len__(self) -> int:
        return len(_BUILDERS)


def _fuel() -> Column:
    listed = value_map("o_orderpriority", FUELS)
    other = F.when(F.col("o_orderstatus") == "P", "hydro").otherwise("oil")
    return _unless(F.col("o_orderkey") % 97 == 0, F.coalesce(listed, other)).alias("fuel_type_code_pudl")


def _owned(t) -> DataFrame:
    return t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))


def _sold(t) -> DataFrame:
    return t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))


def _generation(t) -> DataFrame:
    return t("orders").select(
        F.col("o_custkey").alias("plant_id_eia"),
        _shifted("o_orderdate", "month").alias("report_date"),
        _fuel(),
        _whole("o_totalprice").alias("net_generation_mwh"),
    )


def _generators(t) -> DataFrame:
    place = (F.col("c_nationkey") + (F.col("l_linenumber") == 7).cast("int")) % 25
    area = F.concat(F.lit("BA"), (F.col("c_nationkey") * 5 + F.col("o_custkey") % 3) % 29)
    return (
        t("lineitem")
        .join(_owned(t), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("plant_id_eia"),
            _shifted("o_orderdate", "month").alias("report_date"),
            _unless(F.col("l_orderkey") % 101 == 0, _pick(STATES, place)).alias("state"),
            _fuel(),
            hundredths("l_discount").alias("capacity_factor"),
            _unless(F.col("o_custkey") % 20 == 13, area).alias("balancing_authority_code_eia"),
        )
    )


def _hourly(t) -> DataFrame:
    event, value, user = F.col("event_id"), hundredths("value"), F.col("user_id")
    return t("events").select(
        _unless(user % 20 == 17, F.concat(F.lit("BA"), user % 20)).alias("balancing_authority_code_eia"),
        (F.col("ts") - F.make_ym_interval(F.lit(0), (event % 80).cast("int"))).alias("datetime_utc"),
        _unless(event % 53 == 0, value * 3).alias("net_generation_imputed_eia_mwh"),
        _unless(event % 59 == 0, value * 2 + event % 11).alias("demand_imputed_pudl_mwh"),
        (event % 13 * 5 - value).alias("interchange_adjusted_mwh"),
    )


def _receipts(t) -> DataFrame:
    land, line = F.col("s_nationkey"), F.col("l_linenumber")
    burnt = value_map("l_returnflag", {"A": "gas", "N": "coal", "R": "oil"})
    unpriced = (line == 3) | ((land % 6 == 0) & (line < 6))
    return _sold(t).select(
        _unless(F.col("l_orderkey") % 103 == 0, _pick(STATES, land)).alias("state"),
        F.when((F.col("l_returnflag") == "N") & (land % 5 == 0), "wood").otherwise(burnt).alias("fuel_type_code_pudl"),
        _shifted("l_shipdate", "month").alias("report_date"),
        _whole("l_extendedprice").alias("total_fuel_cost"),
        F.col("l_quantity").alias("fuel_consumed_mmbtu"),
        _unless(unpriced, _whole("l_extendedprice") / F.col("l_quantity")).alias("fuel_cost_per_mmbtu"),
    )


def _sales(t) -> DataFrame:
    order = F.col("o_orderkey")
    return _owned(t).select(
        _pick(STATES, F.col("c_nationkey")).alias("state"),
        _shifted("o_orderdate", "year").alias("report_date"),
        value_map("c_mktsegment", CLASSES, "commercial").alias("customer_class"),
        F.when(F.col("o_orderpriority") == "5-LOW", "cooperative").otherwise("investor_owned").alias("entity_type"),
        (order % 1000 + 1).cast("double").alias("customers"),
        _whole("o_totalprice").alias("sales_mwh"),
        (_whole("o_totalprice") * (order % 7 + 1)).alias("sales_revenue"),
    )


def _reliability(t) -> DataFrame:
    order = F.col("o_orderkey")
    return _owned(t).select(
        _pick(STATES, F.col("c_nationkey")).alias("state"),
        _shifted("o_orderdate", "year").alias("report_date"),
        F.when(F.col("o_orderstatus") == "F", "ieee_standard").otherwise("other_standard").alias("standard"),
        _unless(order % 13 == 0, _whole(F.col("o_totalprice") / 1000)).alias("saidi_wo_major_event_days_minutes"),
        (order % 500).cast("double").alias("customers"),
    )


def _utility_year() -> list[Column]:
    return [
        F.col("l_suppkey").alias("utility_id_eia"),
        _pick(STATES, F.col("s_nationkey")).alias("state"),
        _shifted("l_shipdate", "year").alias("report_date"),
    ]


def _efficiency(t) -> DataFrame:
    return _sold(t).filter(F.col("l_returnflag") == "A").select(
        *_utility_year(),
        F.col("l_quantity").alias("incremental_energy_savings_mwh"),
        F.col("l_linenumber").cast("double").alias("incremental_peak_reduction_mw"),
    )


def _response(t) -> DataFrame:
    _, *where = _utility_year()
    strange = F.when(F.col("l_suppkey") % 9 == 0, -F.col("l_suppkey")).otherwise(F.col("l_suppkey"))  # no sales row has it
    return _sold(t).filter(F.col("l_returnflag") == "R").select(
        strange.alias("utility_id_eia"),
        *where,
        F.col("l_linenumber").cast("double").alias("actual_peak_demand_savings_mw"),
        F.col("l_quantity").alias("energy_savings_mwh"),
    )


def _storage(t) -> DataFrame:
    order = F.col("o_orderkey")
    return t("orders").select(
        F.col("o_custkey").alias("plant_id_eia"),
        _shifted("o_orderdate", "month").alias("report_date"),
        _whole(F.col("o_totalprice") / 1000).alias("max_discharge_rate_mw"),
        (order % 2 == 0).alias("served_arbitrage"),
        (order % 3 == 0).alias("served_frequency_regulation"),
        _unless(order % 4 == 0, order % 5 == 0).alias("served_system_peak_shaving"),
        F.lit(None).cast("boolean").alias("served_backup_power"),
        (F.col("o_orderstatus") == "F").alias("served_ramping_spinning_reserve"),
    )


def _data_centers(t) -> DataFrame:
    key = F.col("n_nationkey")
    homes = t("customer").groupBy("c_nationkey").agg(F.count("c_custkey").alias("sites"), F.sum(_whole("c_acctbal")).alias("load"))
    return t("nation").join(homes, key == F.col("c_nationkey"), "left").select(
        _pick(STATES, key).alias("state"),
        F.coalesce("sites", F.lit(0)).alias("dc_facilities"),
        _unless(key % 11 == 10, F.col("load") / 500000).alias("dc_twh_per_year"),
        (key * 3).cast("double").alias("dc_inventory_mw"),
        _unless(key % 7 == 0, key % 8 * 0.95).alias("dc_announced_investment_usd_b"),
        (key * 22).cast("double").alias("dc_under_construction_mw"),
        (key % 2).alias("dc_grid_constraint_flag"),
        _unless(key % 3 == 0, (key % 5 == 1).cast("int")).alias("dc_fossil_delay_flag"),
        (key % 4 == 3).cast("int").alias("dc_onsite_gen_flag"),
        F.col("n_name").alias("major_hubs"),
        F.concat("n_name", F.lit(" operators")).alias("major_operators"),
    )


def _structure(t) -> DataFrame:
    key = F.col("n_nationkey")
    return t("nation").select(
        _pick(STATES, key).alias("state"),
        _pick(OPERATORS, key % 7).alias("iso_rto"),
        _pick(STRUCTURES, key % 3).alias("market_structure"),
        _unless(key % 9 == 8, key * 2.5).alias("ci_choice_pct"),
    )


def _incentives(t) -> DataFrame:
    key = F.col("n_nationkey")
    return t("nation").select(
        F.when(key % 6 == 5, F.concat(F.lit("not "), _pick(STATES, key))).otherwise(_pick(STATES, key)).alias("state"), (key % 5 + 0.5).cast("decimal(5,2)").alias("incentive_score")
    )


_BUILDERS = {
    "out_eia923__monthly_generation_fuel_combined": _generation,
    "out_eia__monthly_generators": _generators,
    "out_eia930__hourly_operations": _hourly,
    "out_eia923__monthly_fuel_receipts_costs": _receipts,
    "raw_eia861__yearly_sales": _sales,
    "raw_eia861__yearly_reliability": _reliability,
    "raw_eia861__yearly_energy_efficiency": _efficiency,
    "raw_eia861__yearly_demand_response": _response,
    "raw_eia860__storage_generators": _storage,
    "raw_dc_metrics": _data_centers,
    "market_structure_ref": _structure,
    "raw_dsire_incentive_scores": _incentives,
}


def facility_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Territories, facilities and utilities for the territory model."""
    nation, customer, supplier = (table(spark, sf_dir, n) for n in ("nation", "customer", "supplier"))
    key, region = F.col("n_nationkey"), F.col("n_regionkey")
    x, y = key * 12, region * 8
    corners = [(x, y), (x + 25, y), (x + 25, y + 40), (x, y + 40), (x, y)]
    ring = F.array(*[F.struct(a.cast("double").alias("x"), b.cast("double").alias("y")) for a, b in corners])
    features = nation.select(
        key.cast("long").alias("ordinal"),
        F.struct(
            F.when(key % 8 == 7, "INVESTOR OWNED").otherwise("Cooperative").alias("TYPE"),
            F.concat(F.lit("Cooperative of "), F.col("n_name")).alias("NAME"),
            _pick(STATES, key).alias("STATE"),
        ).alias("properties"),
        F.array(F.array(ring)).alias("polygons"),
    )
    place = F.col("c_custkey")
    atlas = customer.select(
        _unless(place % 17 == 0, (place - place % 2).cast("string")).alias("id"),
        _unless(place % 19 == 0, F.col("c_acctbal") / 100).alias("lat"),
        (place % 360).cast("double").alias("lon"),
        _unless(place % 9 == 0, _whole("c_acctbal")).alias("sqft"),
        (place * 7 % 1009 * 1_000_000_000 + place).alias("position"),
    )
    utilities = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        (F.col("s_suppkey") - F.col("s_suppkey") % 2).alias("utility_id_eia"),
        F.concat(F.col("n_name"), F.lit(" cooperative"), F.when(F.col("s_suppkey") % 3 == 0, F.lit(" inc")).otherwise(F.lit(""))).alias(
            "utility_name_eia"
        ),
        _pick(STATES, key).alias("state"),
        F.col("s_suppkey").alias("position"),
    )
    return features, atlas, utilities
