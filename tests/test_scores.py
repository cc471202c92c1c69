from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from statewatt import operators as op
from statewatt.operators import ranking
from statewatt.functions import access_gap_flag, composite_score, composite_total, constraint_points, rule_class, signal_tier, value_map
from statewatt.plans import commercial, integration, residential


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 23])
@pytest.mark.parametrize("kind", ["mixed", "tied", "nulls"])
def test_large_ntile_equals_the_window(spark, n, kind):
    x = {"mixed": "CASE WHEN id % 4 = 0 THEN NULL ELSE (id * 7) % 5 END", "tied": "1", "nulls": "CAST(NULL AS INT)"}[kind]
    df = spark.range(n).selectExpr("id", f"{x} AS x", "concat('s', id) AS name")
    got = op.ntile_scores(df, {"a": "x", "b": "name"}, 5, ["id"])
    w = Window.orderBy(F.col("x").asc_nulls_first(), "id")
    expected = df.withColumns({"a": F.ntile(5).over(w), "b": F.ntile(5).over(Window.orderBy("name", "id"))})
    assert sorted(map(tuple, got.select("id", "a", "b").collect())) == sorted(map(tuple, expected.select("id", "a", "b").collect()))


def test_tables_are_ranked_each_for_itself_in_one_pass(spark):
    a = spark.range(11).selectExpr("concat('s', id) AS state", "CASE WHEN id % 4 > 0 THEN id * 7 % 5 END AS x", "id / 3 AS y")
    b = spark.range(4, 40, 3).selectExpr("concat('s', id) AS state", "-id / 2 AS z")
    got = op.ntile_tables([(a, {"bx": "x", "by": "y"}), (b, {"bz": "z"})], "state")
    left = a.select("state", *[F.ntile(5).over(Window.orderBy(F.col(c).asc_nulls_first(), "state")).alias(f"b{c}") for c in "xy"])
    expected = left.join(b.select("state", F.ntile(5).over(Window.orderBy("z", "state")).alias("bz")), "state", "full")
    assert {tuple(r) for r in got.select("state", "bx", "by", "bz").collect()} == {tuple(r) for r in expected.collect()}
    assert op.ntile_tables([(a.limit(0), {"bx": "x"})], "state").count() == 0


def test_large_ntile_on_a_skewed_column(spark):
    df = spark.range(20000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 5.5D ELSE (id * 7919) % 1000 / 10D END AS x")
    got = op.ntile_score(df, "x", "b", 5, ["id"])
    expected = df.withColumn("e", F.ntile(5).over(Window.orderBy("x", "id")))
    assert got.join(expected, "id").filter("b != e").count() == 0
    sizes = [r["count"] for r in got.groupBy("b").count().collect()]
    assert sizes == [4000] * 5


@pytest.mark.parametrize("kind", ["spread", "two values", "text"])
def test_cuts_are_found_in_several_passes(spark, monkeypatch, kind):
    monkeypatch.setattr(ranking, "HELD", 300)
    monkeypatch.setattr(ranking, "SAMPLE", 200)
    x = {"spread": "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 3 = 0 THEN 5.5D ELSE (id * 7919) % 1000 / 10D END", "two values": "id % 100 < 1", "text": "concat('name ', (id * 31) % 700)"}[kind]
    df = spark.range(3000).selectExpr("id", f"{x} AS x", "CAST(id AS DECIMAL(10, 2)) * (id % 5) AS y")
    got = op.ntile_scores(df, {"a": "x", "b": "y"}, 3, ["id"])
    expected = df.withColumns({"ea": F.ntile(3).over(Window.orderBy(F.col("x").asc_nulls_first(), "id")), "eb": F.ntile(3).over(Window.orderBy("y", "id"))})
    assert got.join(expected, "id").filter("a != ea OR b != eb").count() == 0 and got.count() == 3000
    # without a tie the buckets have their sizes and follow the values
    alone = op.ntile_score(df.select("x"), "x", "b", 3)
    assert sorted(r["count"] for r in alone.groupBy("b").count().collect()) == [1000, 1000, 1000]
    ends = alone.groupBy("b").agg(F.min("x"), F.max("x")).orderBy("b").collect()
    assert all(b[1] is None or (a[2] is None or a[2] <= b[1]) for a, b in zip(ends, ends[1:]))


@pytest.mark.parametrize("desc", [True, False])
def test_large_rank_equals_the_window(spark, desc):
    df = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 5 WHEN id % 50 = 1 THEN NULL ELSE (id * 31) % 997 END AS x")
    got = op.rank_global(df, "x", "r", desc)
    order = F.col("x").desc_nulls_last() if desc else F.col("x").asc_nulls_first()
    expected = df.withColumn("e", F.rank().over(Window.orderBy(order)))
    assert got.join(expected, "id").filter("r != e").count() == 0
    assert got.count() == 5000


def test_large_rank_of_an_empty_table(spark):
    assert op.rank_global(spark.range(0).selectExpr("id", "id AS x"), "x", "r").count() == 0


def test_no_plan_gathers_rows_in_one_task(spark):
    df = spark.range(300_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS x")
    got = op.rank_global(op.ntile_score(df, "x", "b", 5, ["id"]), "x", "r", False)
    assert got.groupBy("b").count().filter("count != 60000").count() == 0
    assert got.filter("x = 1 AND r != 1").count() == got.filter("x = 0").count()


def test_composite_null_rules_and_exact_ties(spark):
    df = spark.createDataFrame([(5, 4, None), (4, 5, 4), (1, 1, 1)], "a int, b int, c int")
    zero = [r[0] for r in df.select(composite_score(["a", "b", "c"], 3)).collect()]
    assert zero == [Decimal("3.00"), Decimal("4.33"), Decimal("1.00")]
    assert [r[0] for r in df.select(composite_score(["a", "b", "c"], nulls="propagate")).collect()][0] is None
    # 13.05 / 6 = 2.175 is a tie: away from zero, where a double would fall below
    tie = spark.createDataFrame([(Decimal("13.05"),), (Decimal("-13.05"),)], "a decimal(5,2)")
    assert [r[0] for r in tie.select(composite_score(["a"], 6)).collect()] == [Decimal("2.18"), Decimal("-2.18")]
    with pytest.raises(ValueError):
        composite_total(["a"], "ignore")


def test_grid_rank_uses_the_unrounded_total(spark):
    # 0.02 and 0.05 apart in the total, equal after / 11 and rounding
    cols = integration.GRID_DIMENSIONS
    data = [(s, *([Decimal("3.00")] * 10), Decimal(x)) for s, x in (("A", "3.00"), ("B", "3.05"), ("C", "3.02"))]
    df = spark.createDataFrame(data, "state string, " + ", ".join(f"{c} decimal(5,2)" for c in cols))
    df = df.withColumns({c: F.lit(None).cast("string") for c in ("dominant_fuel_type", "transition_status", "concentration_class", "gas_high_null_flag")})
    got = {r.state: (r.composite_score, r.opportunity_rank) for r in integration.final_grid(df).collect()}
    assert got == {"A": (Decimal("3.00"), 3), "B": (Decimal("3.00"), 1), "C": (Decimal("3.00"), 2)}


def test_rules_take_the_first_that_holds(spark):
    df = spark.createDataFrame([(5,), (1,), (None,)], "x int")
    label = rule_class([(F.col("x") > 3, "big"), (F.col("x") > 0, "small")], "none")
    assert [r[0] for r in df.select(label).collect()] == ["big", "small", "none"]
    assert [r[0] for r in df.select(value_map("x", {5: "five"})).collect()] == ["five", None, None]


@pytest.mark.parametrize(
    ("invest", "building", "flags", "expected"),
    [
        (0.9, 0.0, (0, 0, 0), "Low"),
        (1.0, 0.0, (0, 0, 0), "Medium"),
        (4.9, None, (0, 0, 0), "Medium"),
        (4.95, None, (0, 0, 0), "Low"),  # between the two ranges
        (4.95, None, (0, None, 1), "Medium"),
        (5.0, None, (None, None, None), "High"),
        (None, 500.0, (0, 0, 0), "High"),
        (None, 499.0, (1, 1, 0), "High"),
        (None, None, (None, None, None), "Low"),
    ],
)
def test_growth_flag(spark, invest, building, flags, expected):
    df = spark.createDataFrame(
        [(invest, building, *flags)],
        "dc_announced_investment_usd_b double, dc_under_construction_mw double, dc_grid_constraint_flag int, dc_fossil_delay_flag int, dc_onsite_gen_flag int",
    )
    assert df.select(commercial.growth_flag()).first()[0] == expected


def test_constraint_points_and_unknown_load(spark):
    df = spark.createDataFrame([(0.4, 1, "PJM"), (0.5, 1, "PJM"), (None, 1, None), (2.0, None, "ERCOT")], "load double, f int, iso string")
    points = constraint_points("load", 0.5, {"f": 3}, value_map("iso", {"PJM": 2, "ERCOT": 0}, 0))
    assert [r[0] for r in df.select(points).collect()] == [0, 5, 3, 0]


@pytest.mark.parametrize(
    ("kind", "operator", "score"),
    [
        ("regulated", "ERCOT", 5),
        ("deregulated", "PJM", 5),
        ("restricted", "MISO", 4),
        ("regulated", "NYISO", 3),
        ("restricted", "non_ISO", 3),
        ("regulated", "non_ISO", 2),
        ("deregulated", "non_ISO", 2),
        ("deregulated", None, 2),
        (None, "PJM", 2),
        (None, None, 2),
    ],
)
def test_market_structure_score(spark, kind, operator, score):
    df = spark.createDataFrame([(kind, operator)], "market_structure string, iso_rto string")
    assert df.select(integration.market_structure_score()).first()[0] == score


def test_access_scores(spark, rows):
    df = spark.createDataFrame([("TX", "ERCOT"), ("NY", "NYISO"), ("DE", "PJM"), ("CA", "CAISO"), ("AL", None)], "state string, iso_rto string")
    got = rows(residential.structure_with_access(df), "state", "residential_access_score", "wholesale_complexity_score")
    assert got == [("AL", 1, 1), ("CA", 2, 1), ("DE", 3, 3), ("NY", 4, 3), ("TX", 5, 5)]


@pytest.mark.parametrize(("pct", "score"), [(None, 1), (4.9, 1), (5.0, 2), (15.0, 3), (30.0, 4), (50.0, 5)])
def test_choice_access(spark, pct, score):
    market = spark.createDataFrame([("TX", 1.0, 1.0, 1.0, 1.0, 1.0)], "state string, ci_customers double, avg_ci_price_per_mwh double, avg_mwh_per_ci_customer double, commercial_customers double, industrial_customers double")
    scores = spark.createDataFrame([("TX", Decimal("3.0"))], "state string, reliability_score decimal(3,1)")
    structure = spark.createDataFrame([("TX", pct)], "state string, ci_choice_pct double")
    centers = spark.createDataFrame([("TX", Decimal("2.67"))], "state string, dc_composite_score decimal(5,2)")
    row = commercial.business_score(market, scores, structure, centers).first()
    assert row.ci_access_score == score
    assert row.ci_composite_score == (Decimal(3 + 3 + score) + Decimal("2.67")).__truediv__(Decimal(6)).quantize(Decimal("0.01"), "ROUND_HALF_UP")


def test_report_rules_need_thresholds(spark):
    df = spark.createDataFrame([(5, 1), (3, 2), (None, 2)], "s int, a int")
    assert [r[0] for r in df.select(access_gap_flag("s", "a", 2)).collect()] == [True, False, None]
    tiers = signal_tier("s", [(3, "amber"), (4, "green")], "red")
    assert [r[0] for r in df.select(tiers).collect()] == ["green", "amber", None]
