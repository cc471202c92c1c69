from __future__ import annotations

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from statewatt import operators as op
from statewatt.operators import ramps

H = [dt.datetime(2020, 1, 31, 22) + dt.timedelta(hours=h) for h in range(8)]  # crosses a month


def series(spark, data):
    return spark.createDataFrame(data, "k string, ts timestamp, v double, u double")


@pytest.fixture
def gaps(spark):
    full = [("full", H[i], v, 1.0) for i, v in enumerate([1.0, 4.0, 2.0, 2.0])]
    holes = [("holes", H[0], 1.0, None), ("holes", H[3], 5.0, None), ("holes", H[4], None, None), ("holes", H[5], 9.0, None), ("holes", H[6], 10.0, None)]
    single = [("single", H[0], 7.0, 7.0)]
    ends = [("ends_null", H[0], 7.0, None), ("ends_null", H[1], None, None)]
    starts = [("starts_null", H[0], None, None), ("starts_null", H[1], 7.0, None)]
    nokey = [(None, H[0], 1.0, 1.0), (None, H[1], 3.0, 1.0)]
    return series(spark, full + holes + single + ends + starts + nokey)


@pytest.mark.parametrize("chunk", ["minute", "hour", "day", "month", "year"])
def test_population_ramps(gaps, chunk):
    got = {r.k: r for r in op.ramp_metrics(gaps, "k", "ts", [op.Ramp("v", "a", "m", "s", 0)], chunk=chunk).collect()}
    # a key needs a row whose previous value is known; the NULL key is a group
    assert set(got) == {"full", "holes", "ends_null", None}
    full = got["full"]
    assert math.isclose(full.a, 5 / 3) and full.m == 3.0 and math.isclose(full.s, statistics.pstdev([3, 2, 0]))
    # the missing hours are bridged, the NULL hour breaks two pairs
    assert (got["holes"].a, got["holes"].m, got["holes"].s) == (2.5, 4.0, 1.5)
    assert (got["ends_null"].a, got["ends_null"].m, got["ends_null"].s) == (None, None, None)
    assert got[None].a == 2.0


@pytest.mark.parametrize("chunk", ["hour", "month"])
def test_sample_ramps_keep_keys_without_pairs(gaps, chunk):
    both = [op.Ramp("v", "a", "m", "s", 1), op.Ramp("u", "ua", "um", "us", 0)]
    got = {r.k: r for r in op.ramp_metrics(gaps, "k", "ts", both, chunk=chunk, drop_first=False).collect()}
    assert set(got) == {"full", "holes", "single", "ends_null", "starts_null"}
    assert math.isclose(got["full"].s, statistics.stdev([3, 2, 0]))
    assert (got["single"].a, got["single"].s) == (None, None)
    assert (got["full"].ua, got["full"].us) == (0.0, 0.0)
    two = op.ramp_metrics(gaps.filter("k = 'full'").limit(2), "k", "ts", [op.Ramp("v", "a", "m", "s", 1)]).first()
    assert two is None or two.s is None


def test_a_hot_key_and_shuffled_rows_do_not_matter(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).cast("string").alias("k"),
        (F.timestamp_seconds(F.lit(1577836800) + F.col("id") * 977)).alias("ts"),
        F.when(F.col("id") % 17 != 0, F.abs(F.hash("id")) % 1000 / 7 + 1e6).alias("v"),
        "id",
    )
    ramp = [op.Ramp("v", "a", "m", "s", 0)]
    reference = df.toPandas().sort_values(["k", "ts"])
    steps = reference.groupby("k")["v"].diff().abs()
    expected = steps.groupby(reference["k"]).agg(["mean", "max", lambda x: x.std(ddof=0)])
    for chunk in ("hour", "day", "week", "year"):
        got = op.ramp_metrics(df.orderBy(F.rand(7)), "k", "ts", ramp, ["id"], chunk).toPandas().set_index("k")
        for k, (mean, top, std) in zip(expected.index, expected.to_numpy()):
            assert math.isclose(got.loc[k, "a"], mean, rel_tol=1e-9)
            assert math.isclose(got.loc[k, "m"], top, rel_tol=1e-12)
            assert math.isclose(got.loc[k, "s"], std, rel_tol=1e-9)


def test_no_step_of_the_plan_gathers_a_whole_key(spark, gaps):
    plan = op.ramp_metrics(gaps, "k", "ts", [op.Ramp("v", "a", "m", "s")])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert plan.count("Exchange hashpartitioning") == 2
    assert "hashpartitioning(k" in plan and "_chunk" in plan.split("Exchange hashpartitioning")[2]


def test_ddof_is_checked():
    with pytest.raises(ValueError):
        op.Ramp("v", "a", "m", "s", 2)


@pytest.mark.parametrize("chunk", ["minute", "hour", "day", "week", "month", "year"])
def test_zoneless_times_do_not_depend_on_the_session_zone(spark, chunk):
    # 02:30 does not exist in this zone on that day
    times = ["2024-03-10 01:50:00", "2024-03-10 02:30:00", "2024-03-10 03:00:00", "2024-03-10 03:30:00"]
    df = spark.createDataFrame([("k", t, v) for t, v in zip(times, [1.0, 2.0, 4.0, 8.0])], "k string, t string, v double")
    df = df.select("k", F.col("t").cast("timestamp_ntz").alias("ts"), "v")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = op.ramp_metrics(df, "k", "ts", [op.Ramp("v", "a", "m", "s")], chunk=chunk).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r.a == pytest.approx(7 / 3) and r.m == 4.0


def test_hourly_history_leaves_few_rows_for_the_second_level(spark):
    df = spark.range(20_000).selectExpr("'one' AS k", "timestamp_seconds(id * 3600) AS ts", "CAST(id % 7 AS DOUBLE) AS v")
    chunks = df.groupBy("k", ramps._chunk(df, "ts", "month").alias("c")).count().count()
    assert chunks <= 20_000 / 500
    assert op.ramp_metrics(df, "k", "ts", [op.Ramp("v", "a", "m", "s")]).first()["m"] == 6.0


@pytest.mark.parametrize("chunk", ["hour", "day", "month"])
def test_a_gap_breaks_the_pair(gaps, chunk):
    hour = dt.timedelta(hours=1)
    got = {r.k: r for r in op.ramp_metrics(gaps, "k", "ts", [op.Ramp("v", "a", "m", "s", 0)], chunk=chunk, max_gap=hour).collect()}
    # of the pairs of "holes" only the last has both values an hour apart
    assert set(got) == {"full", "holes", "ends_null", None}
    assert (got["holes"].a, got["holes"].m, got["holes"].s) == (1.0, 1.0, 0.0)
    assert math.isclose(got["full"].a, 5 / 3)
    wide = {tuple(r) for r in op.ramp_metrics(gaps, "k", "ts", [op.Ramp("v", "a", "m", "s", 0)], chunk=chunk, max_gap=3 * hour).collect()}
    assert wide == {tuple(r) for r in op.ramp_metrics(gaps, "k", "ts", [op.Ramp("v", "a", "m", "s", 0)], chunk=chunk).collect()}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_gaps_are_those_of_lag(spark, kind):
    rng = random.Random(3)
    rows = [(f"k{i % 5}", dt.datetime(2020, 1, 29) + dt.timedelta(minutes=rng.randrange(9000)), rng.choice([None, rng.uniform(0, 9)])) for i in range(600)]
    df = spark.createDataFrame(rows + [("k1", None, 3.0)], f"k string, ts {kind}, v double").dropDuplicates(["k", "ts"])
    df.createOrReplaceTempView("gap_rows")
    want = spark.sql(
        """
        SELECT k, avg(d) AS a, max(d) AS m, stddev_samp(d) AS s FROM (
          SELECT k, abs(v - CASE WHEN ts - lag(ts) OVER w <= INTERVAL 90 MINUTES THEN lag(v) OVER w END) AS d FROM gap_rows WINDOW w AS (PARTITION BY k ORDER BY ts)
        ) GROUP BY k
        """
    )
    got = op.ramp_metrics(df, "k", "ts", [op.Ramp("v", "a", "m", "s", 1)], chunk="month", max_gap=dt.timedelta(minutes=90))
    for x, y in zip(sorted(got.collect()), sorted(want.collect())):
        assert x.k == y.k and all(math.isclose(p, q) for p, q in zip(x[1:], y[1:]))
    assert got.count() == 5
