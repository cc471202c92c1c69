from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from statewatt import operators as op
from statewatt.functions import clean_non_finite
from statewatt.plans import commercial, residential


@pytest.fixture
def table(spark):
    return spark.createDataFrame([("TX", Decimal("1.0")), ("OK", None), (None, Decimal("2.0"))], "state string, score decimal(3,1)")


def test_only_matched_rows_change(spark, table, rows):
    lookup = spark.createDataFrame([("TX", 4.26), ("NM", 9.0), (None, 7.0)], "state string, x double")
    got = op.lookup_update(table, lookup, "state", {"score": F.col("x")})
    assert rows(got) == [(None, Decimal("2.0")), ("OK", None), ("TX", Decimal("4.3"))]
    assert got.schema["score"].dataType == table.schema["score"].dataType


def test_a_matched_null_overwrites_unless_there_is_a_default(spark, table, rows):
    lookup = spark.createDataFrame([("TX", None)], "state string, x double")
    assert rows(op.lookup_update(table, lookup, "state", {"score": F.col("x")}))[-1] == ("TX", None)
    got = op.lookup_update(table, lookup, "state", {"score": F.col("x")}, {"score": 1})
    assert rows(got) == [(None, Decimal("1.0")), ("OK", Decimal("1.0")), ("TX", Decimal("1.0"))]


def test_a_repeated_lookup_key_fails(spark, table):
    lookup = spark.createDataFrame([("TX", 1.0), ("TX", 2.0)], "state string, x double")
    with pytest.raises(PySparkException, match="repeats"):
        op.lookup_update(table, lookup, "state", {"score": F.col("x")}).collect()


def test_a_value_that_does_not_fit_fails(spark, table):
    lookup = spark.createDataFrame([("TX", 123.4)], "state string, x double")
    with pytest.raises(PySparkException):
        op.lookup_update(table, lookup, "state", {"score": F.col("x")}).collect()


def test_the_last_override_wins(spark, rows):
    df = spark.createDataFrame([("CA", "Low"), ("VA", "Low"), ("TX", "Low")], "state string, flag string")
    fixes = spark.createDataFrame([("CA", "High", 1), ("CA", "Medium", 2), ("VA", "High", 1)], "state string, flag string, step int")
    assert rows(op.apply_overrides(df, fixes, "state", "flag", "step")) == [("CA", "Medium"), ("TX", "Low"), ("VA", "High")]


def test_non_finite_numbers_become_null(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(nan, 1.0, 1), (inf, nan, 2), (-inf, 2.0, 3), (None, 3.0, 4), (5.0, None, 5)], "a double, b double, n int")
    assert [tuple(r) for r in clean_non_finite(df).orderBy("n").collect()] == [(None, 1.0, 1), (None, None, 2), (None, 2.0, 3), (None, 3.0, 4), (5.0, None, 5)]
    assert clean_non_finite(df, ["a"]).filter(F.isnan("b")).count() == 1


def test_first_row_per_id(spark, rows):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), (None, 3, "q"), (None, 1, "p"), ("b", 1, None)], "id string, o int, v string")
    assert rows(op.dedup_first(df, "id", ["o"])) == [(None, 1, "p"), ("a", 1, "x"), ("b", 1, None)]


def test_collapse_takes_the_first_known_value(spark, rows):
    df = spark.createDataFrame([(1, None, 1, 5.0), (1, "b", 2, None), (1, "c", 3, 1.0), (2, None, 1, None), (None, "z", 1, 9.0)], "id int, name string, o int, x double")
    assert rows(op.dedup_collapse(df, "id", ["name"], ["x"], ["o"])) == [(1, "b", 6.0), (2, None, 0.0)]


def test_top_k_breaks_ties_in_order(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3), ("d", None)], "k string, n int")
    assert [r.k for r in op.top_k(df, "n", 2, ["k"]).collect()] == ["b", "c"]
    assert "TakeOrderedAndProject" in op.top_k(df, "n", 2, ["k"])._jdf.queryExecution().executedPlan().toString()


def _sales(spark, data):
    df = spark.createDataFrame(data, "state string, customer_class string, customers double, sales_mwh double, sales_revenue double")
    return df.withColumn("report_date", F.lit(dt.date(2024, 1, 1)))


def test_residential_market_guards_and_exclusions(spark, rows):
    sales = _sales(spark, [("TX", "residential", 2.0, 10.0, 25.0), ("TX", "industrial", 9.0, 9.0, 9.0), ("OK", "residential", 0.0, 0.0, 5.0), ("AK", "residential", 1.0, 1.0, 1.0), ("US", "residential", 1.0, 1.0, 1.0)])
    got = rows(residential.residential_market(sales), "state", "residential_customers", "avg_retail_price_per_mwh", "avg_mwh_per_customer")
    assert got == [("OK", 0.0, None, None), ("TX", 2.0, 2.5, 5.0), ("US", 1.0, 1.0, 1.0)]


def test_business_market_keeps_scored_states(spark):
    sales = _sales(spark, [("TX", "commercial", 2.0, 10.0, 25.0), ("TX", "industrial", 1.0, 0.0, 9.0), ("TX", "residential", 9.0, 9.0, 9.0), ("US", "commercial", 1.0, 1.0, 1.0), ("OK", "commercial", 1.0, 1.0, 1.0)])
    scored = spark.createDataFrame([("TX",), ("TX",), ("US",)], "state string")
    got = commercial.business_market(sales, scored).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.ci_customers, r.ci_mwh, r.ci_revenue) == (3.0, 10.0, 34.0)
    assert (r.avg_commercial_price_per_mwh, r.avg_industrial_price_per_mwh, r.avg_ci_price_per_mwh) == (2.5, None, 3.4)
