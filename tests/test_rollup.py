from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from statewatt import operators as op
from statewatt.functions import in_years, ratio
from statewatt.plans import fuel, grid, infrastructure, transition

D = dt.date


def test_fan_out_counts_each_matching_row(spark, rows):
    fact = spark.createDataFrame(
        [(1, D(2020, 1, 1), "gas", 10.0), (1, D(2020, 1, 1), "coal", 5.0), (1, D(2018, 1, 1), "gas", 99.0)],
        "plant_id_eia long, report_date date, fuel_type_code_pudl string, net_generation_mwh double",
    )
    dim = spark.createDataFrame(
        [(1, D(2020, 1, 1), s) for s in ("TX", "TX", "OK", None)] + [(1, D(2018, 1, 1), "TX")],
        "plant_id_eia long, report_date date, state string",
    )
    # two generator rows in TX: every fuel row counts twice there
    assert rows(grid.generation_base(fact, dim), "state", "fuel_type_code_pudl", "period", "monthly_gen_mwh") == [
        ("OK", "coal", "2020-01", 5.0),
        ("OK", "gas", "2020-01", 10.0),
        ("TX", "coal", "2020-01", 10.0),
        ("TX", "gas", "2020-01", 20.0),
    ]
    once = rows(grid.generation_base(fact, dim, "dedup"), "state", "fuel_type_code_pudl", "monthly_gen_mwh")
    assert once == [("OK", "coal", 5.0), ("OK", "gas", 10.0), ("TX", "coal", 5.0), ("TX", "gas", 10.0)]


def test_rollup_equals_the_plain_join_with_a_hot_key(spark, rows):
    fact = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("plant"),
        F.lit(D(2020, 5, 1)).alias("day"),
        (F.col("id") % 4).cast("string").alias("fuel"),
        (F.col("id") * 1.0).alias("mwh"),
    )
    dim = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("plant"),
        F.lit(D(2020, 5, 1)).alias("day"),
        (F.col("id") % 7).cast("string").alias("state"),
    )
    got = op.monthly_rollup(fact, dim, ["plant", "day"], ["state"], ["fuel"], "day", "mwh", "total")
    plain = fact.join(dim, ["plant", "day"]).groupBy("state", "fuel").agg(F.sum("mwh").alias("total"))
    assert rows(got, "state", "fuel", "total") == rows(plain, "state", "fuel", "total")


def test_profile_guards_a_zero_mean(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("a", -1.0, 0.0), ("b", 2.0, 4.0), ("b", 4.0, None)], "k string, x double, y double")
    names = {"avg": "m", "stddev": "s", "range": "r", "cv": "cv"}
    got = {r.k: r for r in op.series_profile(df, ["k"], [op.Profile(F.col("x"), names)]).collect()}
    assert got["a"].cv is None and got["a"].s == 1.0
    assert (got["b"].m, got["b"].s, got["b"].r) == (3.0, 1.0, 2.0)
    assert math.isclose(got["b"].cv, 1 / 3)
    gap = op.Profile(F.col("x") - F.col("y"), {"avg": "g", "cv": "cv"}, cv_base=F.col("y"))
    got = {r.k: r for r in op.series_profile(df, ["k"], [gap]).collect()}
    assert got["a"].cv is None and got["b"].g == -2.0 and got["b"].cv == 0.0


def test_weights_of_unknown_measures_stay_in_the_denominator(spark):
    df = spark.createDataFrame(
        [("a", 2.0, 10.0), ("a", 2.0, None), ("b", None, 7.0), ("c", 0.0, 3.0), (None, 1.0, 1.0)], "k string, w double, x double"
    )
    got = {r.k: r.x for r in op.weighted_rollup(df, "k", "w", ["x"]).collect()}
    assert got == {"a": 5.0, "b": None, "c": None}


def test_an_area_in_two_states_counts_whole_in_each(spark, rows):
    areas = spark.createDataFrame([("A", 4.0), ("B", 12.0)], f"{grid.AREA} string, avg_hourly_gen_mwh double")
    mapping = spark.createDataFrame([("A", "TX"), ("A", "OK"), ("B", "TX"), ("A", None)], f"{grid.AREA} string, state string")
    got = op.weighted_rollup(areas.join(mapping, grid.AREA), "state", "avg_hourly_gen_mwh", ["avg_hourly_gen_mwh"])
    assert rows(got) == [("OK", 4.0), ("TX", 10.0)]


def test_rows_without_category_stay_in_the_total(spark, rows):
    df = spark.createDataFrame([("TX", "gas", 30.0), ("TX", "wind", 30.0), ("TX", None, 40.0), (None, "gas", 1.0)], "state string, fuel string, v double")
    got = op.category_shares(df, "state", "fuel", "v", {"clean": ["wind"]})
    assert rows(got, "state", "fuel", "share", "clean") == [("TX", "gas", 0.3, 0.3), ("TX", "wind", 0.3, 0.3)]


def test_top_category_ties_go_to_the_greatest_name(spark):
    df = spark.createDataFrame([("TX", "gas", 0.5), ("TX", "wind", 0.5), ("OK", "coal", None)], "state string, fuel string, share double")
    got = {r.state: r for r in op.concentration(df, "state", "fuel", "share").collect()}
    assert (got["TX"].hhi, got["TX"].categories, got["TX"].top_share, got["TX"].top_category) == (0.5, 2, 0.5, "wind")
    assert (got["OK"].hhi, got["OK"].categories, got["OK"].top_category) == (None, 1, None)


def test_shift_averages_rounded_annual_shares(spark):
    data = [
        # 2019: 1/3, 2020: 1/2 of the output is wind; the ratio of sums would be 0.4
        ("TX", "wind", "2019-01", 1.0),
        ("TX", "gas", "2019-02", 2.0),
        ("TX", "wind", "2020-01", 1.0),
        ("TX", "gas", "2020-01", 1.0),
        ("TX", "wind", "2022-01", 3.0),
        ("TX", "gas", "2022-01", 1.0),
        ("TX", "wind", "2025-01", 99.0),
        ("TX", "gas", "2018-01", 99.0),
        ("OK", "wind", "2019-01", 1.0),
        ("NM", "wind", "2023-01", 1.0),
        # a zero total has no share, yet the state has rows in both periods
        ("KS", "wind", "2019-01", 0.0),
        ("KS", "wind", "2023-01", 0.0),
    ]
    base = spark.createDataFrame(data, "state string, fuel_type_code_pudl string, period string, monthly_gen_mwh double")
    got = {r.state: r for r in transition.renewable_trend(base).collect()}
    assert set(got) == {"TX", "KS"}
    tx = got["TX"]
    assert tx.early_variable_re_share == round((0.3333 + 0.5) / 2, 4) and tx.late_variable_re_share == 0.75
    assert math.isclose(tx.variable_re_growth, 0.3333 + 0.0000, abs_tol=5e-4)
    assert got["KS"].variable_re_growth is None


def test_rounded_percentages_tie_away_from_zero(spark):
    conc = spark.createDataFrame(
        [("TX", 0.7, 3, 0.9, "gas"), ("OK", 0.4, 2, 0.5, "gas"), ("NM", 0.39, 2, 0.5, "gas")],
        "state string, hhi_concentration double, fuel_type_count long, dominant_fuel_share double, dominant_fuel_type string",
    )
    cols = [
        "early_variable_re_share",
        "late_variable_re_share",
        "variable_re_growth",
        "early_total_re_share",
        "late_total_re_share",
        "total_re_growth",
        "early_fossil_share",
        "late_fossil_share",
        "fossil_share_change",
    ]
    trend = spark.createDataFrame(
        [("TX", 0.5235, 0.1, 0.05, 0.1, 0.1, 0.0, 0.1, 0.1, -0.01), ("OK", 0.1, 0.1, 0.02, 0.1, 0.1, 0.0, 0.1, 0.1, 0.0), ("NM", 0.1, 0.1, None, 0.1, 0.1, 0.0, 0.1, 0.1, -0.0015)],
        "state string, " + ", ".join(f"{x} double" for x in cols),
    )
    got = {r.state: r for r in transition.transition_summary(conc, trend).collect()}
    assert got["TX"].early_variable_re_pct == 52.4
    assert got["NM"].fossil_change_pct == -0.2
    assert [got[s].transition_status for s in ("TX", "OK", "NM")] == ["rapid_transition", "renewable_adding_not_replacing", "fossil_entrenched"]
    assert [got[s].concentration_class for s in ("TX", "OK", "NM")] == ["highly_concentrated", "moderately_concentrated", "diversified"]


def test_price_cost_and_flag(spark):
    receipts = spark.createDataFrame(
        [
            ("TX", "gas", D(2020, 1, 5), 100.0, 50.0, 2.0),
            ("TX", "gas", D(2020, 1, 9), 300.0, 50.0, None),
            ("TX", "gas", D(2020, 2, 9), 70.0, 10.0, 7.0),
            ("TX", "coal", D(2020, 2, 9), 70.0, 0.0, 7.0),
            ("TX", "wood", D(2020, 2, 9), 70.0, 10.0, 7.0),
            ("TX", "oil", D(2020, 2, 9), 0.0, 10.0, 0.0),
            (None, "gas", D(2020, 2, 9), 70.0, 10.0, 7.0),
            ("TX", "gas", D(2018, 2, 9), 70.0, 10.0, 7.0),
        ],
        "state string, fuel_type_code_pudl string, report_date date, total_fuel_cost double, fuel_consumed_mmbtu double, fuel_cost_per_mmbtu double",
    )
    base = fuel.price_base(receipts)
    jan = base.filter("period = '2020-01'").first()
    assert (jan.avg_cost_per_mmbtu, jan.min_cost_per_mmbtu, jan.record_count, jan.null_cost_count) == (4.0, 2.0, 2, 1)
    costs = {(r.fuel_type_code_pudl, r.period): r for r in fuel.cost_per_mwh(base).collect()}
    assert ("coal", "2020-02") not in costs  # no consumption, no price
    assert costs["gas", "2020-01"].null_pct == Decimal("50.0") and costs["gas", "2020-01"].est_cost_per_mwh == 28.0
    assert costs["wood", "2020-02"].est_cost_per_mwh is None
    stats = fuel.cost_metrics(fuel.cost_per_mwh(base)).collect()
    assert len(stats) == 1  # wood has no factor, oil costs nothing
    assert (stats[0].month_count, stats[0].avg_cost_per_mwh, stats[0].std_dev_cost_per_mwh) == (2, 38.5, 10.5)
    assert stats[0].high_null_flag == 0 and float(stats[0].avg_null_pct) == 25.0


def test_null_percentage_is_rounded_before_it_is_averaged(spark):
    # 1/3 -> 33.3, 2/3 -> 66.7: averages to 50.0
    df = spark.createDataFrame([("gas", 1.0, 3, 1), ("gas", 1.0, 3, 2)], "fuel string, price double, n long, nulls long")
    costs = op.normalised_cost(df, "fuel", "price", {"gas": 7.0}, "n", "nulls")
    assert sorted(r.null_pct for r in costs.collect()) == [Decimal("33.3"), Decimal("66.7")]
    assert op.cost_stats(costs, ["fuel"], "unit_cost", "null_pct", 50).first().high_null_flag == 1


def test_spread_needs_the_base_and_flags_any_side(spark):
    df = spark.createDataFrame(
        [("TX", "gas", 30.0, 0), ("TX", "coal", 20.0, 1), ("OK", "gas", 10.0, 0), ("OK", "oil", 50.0, None), ("NM", "coal", 1.0, 1)],
        "state string, fuel_type_code_pudl string, avg_cost_per_mwh double, high_null_flag int",
    )
    got = {r.state: r for r in fuel.cost_spread(df).collect()}
    assert set(got) == {"TX", "OK"}
    assert (got["TX"].gas_coal_spread, got["TX"].gas_oil_spread, got["TX"].any_high_null_flag) == (10.0, None, 1)
    assert (got["OK"].gas_oil_spread, got["OK"].oil_coal_spread, got["OK"].any_high_null_flag) == (-40.0, None, 0)


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [None, None, 0.25]


def test_two_sided_fan_out(spark, rows):
    ee = spark.createDataFrame(
        [(1, "TX", D(2024, 1, 1), 10.0, 1.0), (1, "TX", D(2024, 1, 1), 20.0, 2.0), (2, "TX", D(2024, 1, 1), 5.0, 1.0), (3, "OK", D(2024, 1, 1), 7.0, None), (4, "AK", D(2024, 1, 1), 7.0, 1.0), (1, "TX", D(2023, 1, 1), 99.0, 9.0)],
        "utility_id_eia long, state string, report_date date, incremental_energy_savings_mwh double, incremental_peak_reduction_mw double",
    )
    dr = spark.createDataFrame(
        [(1, "TX", D(2024, 1, 1), x, 1.0) for x in (1.0, 2.0, 3.0)] + [(9, "TX", D(2024, 1, 1), 50.0, 50.0)],
        "utility_id_eia long, state string, report_date date, actual_peak_demand_savings_mw double, energy_savings_mwh double",
    )
    # utility 1: two rows x three rows, utility 2 unmatched
    assert rows(infrastructure.regulatory_receptiveness(ee, dr)) == [("OK", 7.0, None, 0.0, 0.0), ("TX", 95.0, 10.0, 12.0, 6.0)]
    assert rows(infrastructure.regulatory_receptiveness(ee, dr, "dedup")) == [("OK", 7.0, None, 0.0, 0.0), ("TX", 35.0, 4.0, 6.0, 3.0)]


def test_storage_counts_a_plant_in_each_of_its_states(spark):
    storage = spark.createDataFrame(
        [(1, D(2024, 3, 1), 2.4, True, None), (1, D(2024, 9, 1), 3.0, False, None), (2, D(2024, 1, 1), None, True, None), (1, D(2023, 1, 1), 9.0, True, True)],
        "plant_id_eia long, report_date date, max_discharge_rate_mw double, served_arbitrage boolean, served_backup_power boolean",
    ).withColumns({f"served_{x}": F.lit(True) for x in ("frequency_regulation", "system_peak_shaving", "ramping_spinning_reserve")})
    gens = spark.createDataFrame([(1, "TX"), (1, "TX"), (1, "OK"), (2, "AK"), (2, None)], "plant_id_eia long, state string")
    got = {r.state: r for r in infrastructure.storage_deployment(storage, gens).collect()}
    assert set(got) == {"TX", "OK"}
    tx = got["TX"]
    assert (tx.storage_units, tx.total_discharge_mw, tx.units_arbitrage, tx.units_backup_power, tx.total_use_case_activations) == (2, 5.0, 1, None, 7)


def test_reliability_filters_and_exact_years(spark):
    df = spark.createDataFrame(
        [
            ("TX", D(2019, 1, 1), "ieee_standard", 100.0, 1.0),
            ("TX", D(2024, 12, 31), "ieee_standard", 200.0, 3.0),
            ("TX", D(2025, 1, 1), "ieee_standard", 900.0, 3.0),
            ("TX", D(2024, 1, 1), "other_standard", 900.0, 3.0),
            ("TX", D(2024, 1, 1), "ieee_standard", None, 3.0),
            ("TX", D(2024, 1, 1), "ieee_standard", 900.0, 0.0),
            ("HI", D(2024, 1, 1), "ieee_standard", 900.0, 1.0),
        ],
        "state string, report_date date, standard string, saidi_wo_major_event_days_minutes double, customers double",
    )
    got = infrastructure.reliability(df).collect()
    assert [(r.state, r.saidi_weighted_avg, r.total_customers, r.years_covered) for r in got] == [("TX", 175.0, 4.0, 2)]


def test_cooperative_states(spark, rows):
    sales = spark.createDataFrame(
        [("TX", "cooperative", 1.0, 10.0), ("TX", "municipal", 2.0, 0.0), ("US", "cooperative", 9.0, 9.0), ("AK", "cooperative", 1.0, 1.0), ("OK", "cooperative", 0.0, 1.0), ("NM", "cooperative", 5.0, 0.0)],
        "state string, entity_type string, customers double, sales_mwh double",
    ).withColumn("report_date", F.lit(D(2024, 1, 1)))
    reliable = spark.createDataFrame([("TX", 175.0), ("OK", 1.0), ("NM", 2.0), ("US", 3.0)], "state string, saidi_weighted_avg double")
    # AK has no reliability row, OK no customers, NM no sales to divide by
    assert rows(infrastructure.cooperative_density(sales, reliable)) == [("NM", 100.0, None, 2.0), ("TX", 33.3, 100.0, 175.0)]


def test_year_range_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(D(2024, 1, 1), 1.0)], "d date, x double").write.parquet(path)
    plan = spark.read.parquet(path).filter(in_years("d", 2024))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2024-01-01)" in plan and "LessThan(d,2025-01-01)" in plan


def test_bad_options_are_refused(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        op.monthly_rollup(df, df, ["id"], [], [], "id", "id", "x", fanout="maybe")
    with pytest.raises(ValueError):
        op.m2m_left_sums(df, df, ["id"], "other", {}, {})
