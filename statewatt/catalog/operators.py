"""Roll-ups, profiles, ramps, shares, scores and rules on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from statewatt import operators as op
from statewatt.catalog.registry import as_double, as_long, hundredths, money, query, rounded, table
from statewatt.functions import (
    access_gap_flag,
    clean_non_finite,
    composite_score,
    composite_total,
    constraint_points,
    in_years,
    indicator_count,
    month_period,
    rule_class,
    signal_tier,
    value_map,
)
from statewatt.sources import load_table

# --- ramps and profiles ----------------------------------------------------


def _ramps(spark, sf, ddof):
    events = table(spark, sf, "events").withColumn("value", hundredths("value"))
    out = op.ramp_metrics(
        events, "user_id", "ts", [op.Ramp("value", "avg_ramp", "max_ramp", "std_dev_ramp", ddof)], ["event_id"]
    )
    return rounded(out, 6, "std_dev_ramp")


_RAMP_SQL = """
WITH steps AS (
  SELECT user_id, abs(v - lag(v) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS step
  FROM (SELECT user_id, ts, event_id, round(value * 100) AS v FROM events))
SELECT user_id, avg(step) AS avg_ramp, max(step) AS max_ramp, round({std}(step), 6) AS std_dev_ramp
FROM steps WHERE step IS NOT NULL GROUP BY user_id"""


@query("ramp_pop", _RAMP_SQL.format(std="stddev_pop"))
def ramp_pop(spark, sf):
    return _ramps(spark, sf, 0)


@query("ramp_samp", _RAMP_SQL.format(std="stddev_samp"))
def ramp_samp(spark, sf):
    return _ramps(spark, sf, 1)


@query(
    "series_profile",
    """SELECT user_id, avg(v) AS avg_value, round(stddev_pop(v), 6) AS std_dev_value, max(v) AS max_value, min(v) AS min_value,
       max(v) - min(v) AS range_value, round(stddev_pop(v) / nullif(avg(v), 0), 6) AS cv_value
FROM (SELECT user_id, round(value * 100) AS v FROM events) GROUP BY user_id""",
)
def series_profile(spark, sf):
    names = {s: f"{s}_value" for s in ("avg", "max", "min", "range", "cv")} | {"stddev": "std_dev_value"}
    out = op.series_profile(table(spark, sf, "events"), ["user_id"], [op.Profile(hundredths("value"), names)])
    return rounded(out, 6, "std_dev_value", "cv_value")


@query(
    "gap_profile",
    """WITH g AS (SELECT l_suppkey, round(l_extendedprice * 100) - l_quantity * 100000 AS gap, l_quantity * 100000 AS need FROM lineitem)
SELECT l_suppkey, avg(gap) AS avg_gap, round(stddev_pop(gap), 3) AS std_dev_gap, max(gap) AS max_surplus, min(gap) AS max_deficit,
       round(stddev_pop(gap) / nullif(avg(need), 0), 6) AS cv_gap
FROM g GROUP BY l_suppkey""",
)
def gap_profile(spark, sf):
    need = F.col("l_quantity") * 100000
    names = {"avg": "avg_gap", "stddev": "std_dev_gap", "max": "max_surplus", "min": "max_deficit", "cv": "cv_gap"}
    gap = op.Profile(hundredths("l_extendedprice") - need, names, cv_base=need)
    out = op.series_profile(table(spark, sf, "lineitem"), ["l_suppkey"], [gap])
    return rounded(rounded(out, 3, "std_dev_gap"), 6, "cv_gap")


# --- roll-ups ----------------------------------------------------------------


def _fanout(spark, sf, fanout):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("orderkey"), "o_orderdate", "o_orderpriority", money("o_totalprice").alias("amount")
    )
    items = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_returnflag")
    out = op.monthly_rollup(
        orders, items, ["orderkey"], ["l_returnflag"], ["o_orderpriority"], "o_orderdate", "amount", "amount", "1996-01-01", fanout
    )
    return as_double(out, "amount")


@query(
    "fanout_monthly",
    """SELECT l_returnflag, o_orderpriority, strftime(o_orderdate, '%Y-%m') AS period,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE o_orderdate >= DATE '1996-01-01' GROUP BY ALL""",
)
def fanout_monthly(spark, sf):
    return _fanout(spark, sf, "keep")


@query(
    "fanout_monthly_dedup",
    """SELECT l_returnflag, o_orderpriority, strftime(o_orderdate, '%Y-%m') AS period,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM orders JOIN (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem) d ON o_orderkey = d.l_orderkey
WHERE o_orderdate >= DATE '1996-01-01' GROUP BY ALL""",
)
def fanout_monthly_dedup(spark, sf):
    return _fanout(spark, sf, "dedup")


def _segment_totals(spark, sf):
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .groupBy("c_nationkey", "c_mktsegment")
        .agg(F.sum(money("o_totalprice")).alias("amount"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("n_name", "c_mktsegment", "amount")
    )


_SEGMENTS_SQL = """seg AS (
  SELECT n_name, c_mktsegment, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
shares AS (SELECT *, amount / nullif(CAST(sum(CAST(amount AS DECIMAL(18,2))) OVER (PARTITION BY n_name) AS DOUBLE), 0) AS share FROM seg)"""


@query(
    "category_shares",
    f"""WITH {_SEGMENTS_SQL}
SELECT n_name, c_mktsegment, round(share, 9) AS share,
       round(sum(CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN share ELSE 0 END) OVER (PARTITION BY n_name), 9) AS home_share,
       round(sum(CASE WHEN c_mktsegment = 'MACHINERY' THEN share ELSE 0 END) OVER (PARTITION BY n_name), 9) AS machine_share
FROM shares""",
)
def category_shares(spark, sf):
    groups = {"home_share": ["HOUSEHOLD", "FURNITURE"], "machine_share": ["MACHINERY"]}
    out = op.category_shares(_segment_totals(spark, sf), "n_name", "c_mktsegment", "amount", groups)
    return rounded(out.drop("amount"), 9, "share", "home_share", "machine_share")


@query(
    "hhi_concentration",
    f"""WITH {_SEGMENTS_SQL}
SELECT n_name, round(sum(share * share), 4) AS hhi, count(c_mktsegment) AS categories,
       round(max(share), 9) AS top_share, arg_max(c_mktsegment, share) AS top_category
FROM shares GROUP BY n_name""",
)
def hhi_concentration(spark, sf):
    shares = op.category_shares(_segment_totals(spark, sf), "n_name", "c_mktsegment", "amount", {})
    return rounded(op.concentration(shares, "n_name", "c_mktsegment", "share"), 9, "top_share")


@query(
    "weighted_rollup",
    """WITH u AS (SELECT user_id, avg(value) AS m, stddev_pop(value) AS s, max(value) AS hi, min(value) AS lo
           FROM events GROUP BY user_id),
j AS (SELECT n_name, u.* FROM u JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT n_name, round(sum(m * m) / nullif(sum(m), 0), 6) AS avg_value, round(sum(s * m) / nullif(sum(m), 0), 6) AS std_dev_value,
       max(hi) AS max_value, min(lo) AS min_value, round(max(hi) - min(lo), 6) AS range_value,
       round(sum(s * m) / nullif(sum(m * m), 0), 6) AS cv_value
FROM j GROUP BY n_name""",
)
def weighted_rollup(spark, sf):
    names = {"avg": "avg_value", "stddev": "std_dev_value", "max": "max_value", "min": "min_value"}
    users = op.series_profile(table(spark, sf, "events"), ["user_id"], [op.Profile(F.col("value"), names)])
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    placed = users.join(customer, users.user_id == customer.c_custkey).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    out = op.weighted_rollup(
        placed,
        "n_name",
        "avg_value",
        ["avg_value", "std_dev_value"],
        ["max_value"],
        ["min_value"],
        {"range_value": ("max_value", "min_value")},
        {"cv_value": ("std_dev_value", "avg_value")},
    )
    return rounded(out, 6, "avg_value", "std_dev_value", "range_value", "cv_value")


def _monthly_prices(spark, sf):
    unit = F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice") / F.col("l_quantity"))
    items = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_shipdate", money("l_extendedprice").alias("cost"), money("l_quantity").alias("volume"), unit.alias("unit")
    )
    return op.volume_weighted_price(items, ["l_returnflag"], "l_shipdate", "cost", "volume", "unit", since="1996-01-01")


_PRICES_SQL = """prices AS (
  SELECT l_returnflag, strftime(l_shipdate, '%Y-%m') AS period,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_cost,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_volume,
         min(CASE WHEN l_linenumber <> 3 THEN l_extendedprice / l_quantity END) AS min_price,
         max(CASE WHEN l_linenumber <> 3 THEN l_extendedprice / l_quantity END) AS max_price,
         count(*) AS record_count, count(*) FILTER (l_linenumber = 3) AS null_count
  FROM lineitem WHERE l_shipdate >= DATE '1996-01-01' GROUP BY ALL),
priced AS (SELECT *, total_cost / nullif(total_volume, 0) AS avg_price FROM prices)"""


@query(
    "vw_price",
    f"""WITH {_PRICES_SQL}
SELECT l_returnflag, period, round(avg_price, 6) AS avg_price, round(min_price, 6) AS min_price,
       round(max_price, 6) AS max_price, total_volume, total_cost, record_count, null_count FROM priced""",
)
def vw_price(spark, sf):
    out = as_double(_monthly_prices(spark, sf), "total_volume", "total_cost")
    return rounded(out, 6, "avg_price", "min_price", "max_price")


_COST_SQL = f"""{_PRICES_SQL},
costs AS (
  SELECT l_returnflag, avg_price * CASE l_returnflag WHEN 'A' THEN 7.0 WHEN 'N' THEN 10.5 END AS cost,
         round(CAST(null_count AS DECIMAL(18,0)) * 100 / record_count, 1) AS pct FROM priced WHERE avg_price IS NOT NULL),
stats AS (
  SELECT l_returnflag, count(*) AS month_count, round(avg(cost), 2) AS avg_cost, round(min(cost), 2) AS min_cost,
         round(max(cost), 2) AS max_cost, round(stddev_pop(cost), 2) AS std_dev_cost,
         round(max(cost) - min(cost), 2) AS cost_range, round(stddev_pop(cost) / nullif(avg(cost), 0), 4) AS cv_cost,
         round(avg(pct), 1) AS avg_null_pct, CAST(avg(pct) >= 14.5 AS BIGINT) AS high_null_flag
  FROM costs WHERE cost > 0 GROUP BY l_returnflag)"""


@query("normalised_cost_stats", f"WITH {_COST_SQL} SELECT * FROM stats")
def normalised_cost_stats(spark, sf):
    costs = op.normalised_cost(
        _monthly_prices(spark, sf), "l_returnflag", "avg_price", {"A": 7.0, "N": 10.5}, "record_count", "null_count"
    )
    out = op.cost_stats(costs, ["l_returnflag"], "unit_cost", "null_pct", 14.5)
    return as_long(as_double(out, "avg_null_pct"), "high_null_flag")


@query(
    "load_table",
    "SELECT l_orderkey, l_linenumber, l_quantity, upper(trim(l_returnflag)) AS l_returnflag FROM lineitem",
)
def loaded(spark, sf):
    schema = StructType().add("l_orderkey", LongType()).add("l_linenumber", table(spark, sf, "lineitem").schema["l_linenumber"].dataType)
    schema = schema.add("l_quantity", DoubleType()).add("l_returnflag", StringType())
    return load_table(spark, f"{sf}/lineitem.parquet", schema, {"l_returnflag": "upper"})


@query(
    "category_spread",
    """WITH m AS (
  SELECT n_name, n_nationkey, CASE WHEN n_nationkey % 3 = 0 AND l_returnflag <> 'A' THEN 'other' ELSE l_returnflag END AS cat,
         avg(round(l_extendedprice * 100)) AS v, CAST(n_nationkey % 4 = 0 AND cat = 'R' AS BIGINT) AS f
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)
SELECT a.n_name, round(a.v, 4) AS a_cost, round(n.v, 4) AS n_cost, round(r.v, 4) AS r_cost, round(a.v - n.v, 2) AS a_n_spread,
       round(a.v - r.v, 2) AS a_r_spread, round(r.v - n.v, 2) AS r_n_spread,
       CASE WHEN a.f = 1 OR n.f = 1 OR r.f = 1 THEN 1 ELSE 0 END AS any_flag
FROM m a LEFT JOIN m n ON a.n_name = n.n_name AND n.cat = 'N' LEFT JOIN m r ON a.n_name = r.n_name AND r.cat = 'R'
WHERE a.cat = 'A'""",
)
def category_spread(spark, sf):
    items, supplier, nation = (table(spark, sf, t) for t in ("lineitem", "supplier", "nation"))
    placed = items.join(supplier, items.l_suppkey == supplier.s_suppkey).join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    other = (F.col("n_nationkey") % 3 == 0) & (F.col("l_returnflag") != "A")
    named = placed.withColumn("l_returnflag", F.when(other, "other").otherwise(F.col("l_returnflag")))
    means = named.groupBy("n_name", "n_nationkey", "l_returnflag").agg(F.avg(hundredths("l_extendedprice")).alias("cost"))
    means = means.withColumn("flag", F.when((F.col("n_nationkey") % 4 == 0) & (F.col("l_returnflag") == "R"), 1).otherwise(0))
    out = op.category_spread(
        means,
        "n_name",
        "l_returnflag",
        "cost",
        "flag",
        {"A": "a_cost", "N": "n_cost", "R": "r_cost"},
        {"a_n_spread": ("A", "N"), "a_r_spread": ("A", "R"), "r_n_spread": ("R", "N")},
        base="A",
    )
    return rounded(out, 4, "a_cost", "n_cost", "r_cost")


@query(
    "period_shift",
    """WITH y AS (
  SELECT n_name, left(strftime(o_orderdate, '%Y-%m'), 4) AS yr,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
         CAST(sum(CAST(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN o_totalprice ELSE 0 END AS DECIMAL(18,2))) AS DOUBLE) AS h,
         CAST(sum(CAST(CASE WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN o_totalprice ELSE 0 END AS DECIMAL(18,2))) AS DOUBLE) AS g
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
s AS (SELECT n_name, yr, round(h / nullif(total, 0), 4) AS h, round(g / nullif(total, 0), 4) AS g FROM y),
e AS (SELECT n_name, avg(h) AS h, avg(g) AS g FROM s WHERE yr IN ('1995', '1996', '1997') GROUP BY n_name),
l AS (SELECT n_name, avg(h) AS h, avg(g) AS g FROM s WHERE yr IN ('1998', '1999', '2000') GROUP BY n_name)
SELECT n_name, round(e.h, 4) AS early_household, round(l.h, 4) AS late_household, round(l.h - e.h, 4) AS household_growth,
       round(e.g, 4) AS early_goods, round(l.g, 4) AS late_goods, round(l.g - e.g, 4) AS goods_change
FROM e JOIN l USING (n_name)""",
)
def period_shift(spark, sf):
    orders, customer, nation = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    base = orders.join(customer, orders.o_custkey == customer.c_custkey).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    base = base.select("n_name", "c_mktsegment", month_period("o_orderdate").alias("period"), money("o_totalprice").alias("amount"))
    return op.period_shift(
        base,
        "n_name",
        F.left("period", F.lit(4)),
        "c_mktsegment",
        "amount",
        {"household": ["HOUSEHOLD"], "goods": ["FURNITURE", "MACHINERY"]},
        ["1995", "1996", "1997"],
        ["1998", "1999", "2000"],
        {"household": "household_growth"},
    )


# --- market bases --------------------------------------------------------------


@query(
    "weighted_reliability",
    """SELECT c_mktsegment, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)) * c_custkey) AS DOUBLE) / nullif(sum(c_custkey), 0), 1) AS weighted_avg,
       CAST(sum(c_custkey) AS BIGINT) AS total_weight, count(DISTINCT year(o_orderdate)) AS years_covered
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus = 'F' AND o_totalprice IS NOT NULL AND c_custkey > 0 AND year(o_orderdate) BETWEEN 1996 AND 1999
GROUP BY c_mktsegment""",
)
def weighted_reliability(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    rows = orders.filter(F.col("o_orderstatus") == "F").join(customer, orders.o_custkey == customer.c_custkey)
    return op.weighted_reliability(rows, "c_mktsegment", "o_totalprice", "c_custkey", "o_orderdate", (1996, 1999))


@query(
    "class_share",
    """WITH s AS (
  SELECT n_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F') AS DOUBLE) AS f,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS t
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE year(o_orderdate) = 1998 AND n_name NOT IN ('NATION_3', 'NATION_4') GROUP BY n_name)
SELECT n_name, round(coalesce(f, 0), 0) AS closed_amount, round(t, 0) AS total_amount,
       round(coalesce(f, 0) / nullif(t, 0) * 100, 2) AS closed_pct FROM s""",
)
def class_share(spark, sf):
    orders, customer, nation = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    rows = orders.filter(in_years("o_orderdate", 1998)).join(customer, orders.o_custkey == customer.c_custkey)
    rows = rows.join(nation.filter(~F.col("n_name").isin("NATION_3", "NATION_4")), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select("n_name", "o_orderstatus", money("o_totalprice").alias("amount"))
    out = op.class_share(
        rows, "n_name", "o_orderstatus", {"amount": "closed_pct"}, ["F"], ["F", "O", "P"], 2, {"amount": ("closed_amount", "total_amount")}
    )
    return as_double(out, "closed_amount", "total_amount")


@query(
    "flag_activation",
    """SELECT n_name, count(*) AS units, round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 0) AS total_size,
       count(*) FILTER (event_type = 'click') AS units_click, count(*) FILTER (event_type = 'view') AS units_view,
       count(*) FILTER (event_type = 'error') AS units_error,
       count(*) FILTER (event_type IN ('click', 'view', 'error')) AS total_activations
FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def flag_activation(spark, sf):
    events, customer, nation = (table(spark, sf, t) for t in ("events", "customer", "nation"))
    kinds = ["click", "view", "error"]
    rows = events.join(customer, events.user_id == customer.c_custkey).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select("n_name", money("value").alias("size"), *[(F.col("event_type") == k).alias(f"is_{k}") for k in kinds])
    return as_double(op.flag_activation(rows, "n_name", {f"is_{k}": f"units_{k}" for k in kinds}, "size"), "total_size")


@query(
    "market_base",
    """WITH b AS (
  SELECT n_name, count(*) FILTER (c_mktsegment = 'HOUSEHOLD') AS h_orders,
         CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (c_mktsegment = 'HOUSEHOLD'), 0) AS DOUBLE) AS h_amount,
         count(*) FILTER (c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')) AS hm_orders,
         CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')), 0) AS DOUBLE) AS hm_amount,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)
SELECT *, round(CASE WHEN h_orders > 0 THEN h_amount / h_orders END, 6) AS h_price,
       round(CASE WHEN hm_orders > 0 THEN hm_amount / hm_orders END, 6) AS hm_price FROM b""",
)
def market_base(spark, sf):
    orders, customer, nation = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select("n_name", "c_mktsegment", F.lit(1).alias("one"), money("o_totalprice").alias("amount_in"))
    h, hm = ["HOUSEHOLD"], ["HOUSEHOLD", "MACHINERY"]
    sums = {
        "h_orders": ("one", h),
        "h_amount": ("amount_in", h),
        "hm_orders": ("one", hm),
        "hm_amount": ("amount_in", hm),
        "amount": ("amount_in", None),
    }
    ratios = {"h_price": ("h_amount", "h_orders"), "hm_price": ("hm_amount", "hm_orders")}
    out = op.market_base(rows, "n_name", sums, ratios, "c_mktsegment")
    return as_double(rounded(out, 6, "h_price", "hm_price"), "h_amount", "hm_amount", "amount")


# --- scores, ranks, rules --------------------------------------------------------

_NULLABLE_BAL = "CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END"


@query(
    "ntile_score",
    f"""SELECT c_custkey, CAST(ntile(5) OVER (ORDER BY {_NULLABLE_BAL} ASC NULLS FIRST, c_custkey) AS BIGINT) AS bal_score,
       CAST(ntile(5) OVER (ORDER BY c_mktsegment ASC NULLS FIRST, c_custkey) AS BIGINT) AS segment_score FROM customer""",
)
def ntile_score(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("bal")
    )
    out = op.ntile_scores(rows, {"bal_score": "bal", "segment_score": "c_mktsegment"}, 5, ["c_custkey"])
    return as_long(out.select("c_custkey", "bal_score", "segment_score"), "bal_score", "segment_score")


@query(
    "rank_global",
    f"""SELECT c_custkey, CAST(rank() OVER (ORDER BY round({_NULLABLE_BAL}, 0) DESC NULLS LAST) AS BIGINT) AS bal_rank FROM customer""",
)
def rank_global(spark, sf):
    bal = F.round(F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")), 0)
    rows = table(spark, sf, "customer").select("c_custkey", bal.alias("bal"))
    return as_long(op.rank_global(rows, "bal", "bal_rank").select("c_custkey", "bal_rank"), "bal_rank")


def _composite(spark, sf, third):
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey", third.alias("fixed"))
    return op.ntile_scores(rows, {"s1": "c_acctbal", "s2": "c_nationkey"}, 5, ["c_custkey"])


_COMPOSITE_SQL = """WITH s AS (
  SELECT c_custkey, ntile(5) OVER (ORDER BY c_acctbal NULLS FIRST, c_custkey) AS s1,
         ntile(5) OVER (ORDER BY c_nationkey NULLS FIRST, c_custkey) AS s2, {third} AS fixed FROM customer),
t AS (SELECT c_custkey, {total} AS total FROM s)
SELECT c_custkey, CAST(round(CAST(total AS DECIMAL(18,6)) / 3.0, 2) AS DOUBLE) AS composite,
       CAST(rank() OVER (ORDER BY total DESC NULLS LAST) AS BIGINT) AS opportunity_rank FROM t"""


@query("composite_rank", _COMPOSITE_SQL.format(third="CASE WHEN c_custkey % 5 <> 0 THEN 3 END", total="s1 + s2 + coalesce(fixed, 0)"))
def composite_rank(spark, sf):
    dims = ["s1", "s2", "fixed"]
    scored = _composite(spark, sf, F.when(F.col("c_custkey") % 5 != 0, 3))
    scored = scored.select("c_custkey", composite_score(dims).alias("composite"), composite_total(dims).alias("total"))
    out = op.rank_global(scored, "total", "opportunity_rank").drop("total")
    return as_long(as_double(out, "composite"), "opportunity_rank")


@query("composite_null_propagate", _COMPOSITE_SQL.format(third="CASE WHEN c_custkey % 5 <> 0 THEN 3 END", total="s1 + s2 + fixed"))
def composite_null_propagate(spark, sf):
    dims = ["s1", "s2", "fixed"]
    scored = _composite(spark, sf, F.when(F.col("c_custkey") % 5 != 0, 3))
    scored = scored.select("c_custkey", composite_score(dims, nulls="propagate").alias("composite"))
    out = op.rank_global(scored, "composite", "opportunity_rank")
    return as_long(as_double(out, "composite"), "opportunity_rank")


_NATION_BASE_SQL = """nat AS (
  SELECT n_name, n_nationkey, r_name, count(c_custkey) AS n, round(CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_custkey), 4) AS bal
  FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY ALL)"""


def _nations(spark, sf):
    nation, region, customer = (table(spark, sf, t) for t in ("nation", "region", "customer"))
    counts = customer.groupBy("c_nationkey").agg(F.count("c_custkey").alias("n"), F.sum(money("c_acctbal")).alias("total"))
    rows = nation.join(region, nation.n_regionkey == region.r_regionkey).join(counts, nation.n_nationkey == counts.c_nationkey, "left")
    bal = F.round(F.try_divide(F.col("total").cast("double"), F.col("n")), 4)
    return rows.select("n_name", "n_nationkey", "r_name", F.coalesce("n", F.lit(0)).alias("n"), bal.alias("bal"))


@query(
    "rule_class",
    f"""WITH {_NATION_BASE_SQL}
SELECT n_name, CASE WHEN bal >= 5000 AND n > 60 THEN 'strong' WHEN bal >= 5000 THEN 'rich' WHEN n > 60 THEN 'wide' ELSE 'weak' END AS label,
       CASE r_name WHEN 'AFRICA' THEN 3 WHEN 'ASIA' THEN 2 WHEN 'EUROPE' THEN 1 ELSE 0 END AS points FROM nat""",
)
def rule_class_query(spark, sf):
    rich, wide = F.col("bal") >= 5000, F.col("n") > 60
    rules = [(rich & wide, "strong"), (rich, "rich"), (wide, "wide")]
    points = value_map("r_name", {"AFRICA": 3, "ASIA": 2, "EUROPE": 1}, 0)
    return _nations(spark, sf).select("n_name", rule_class(rules, "weak").alias("label"), points.alias("points"))


@query(
    "constraint_points",
    f"""WITH {_NATION_BASE_SQL},
f AS (SELECT *, CAST(n_nationkey % 2 = 0 AS INT) AS grid, CASE WHEN n_nationkey % 3 <> 0 THEN CAST(n_nationkey % 5 = 1 AS INT) END AS fossil,
             CAST(n_nationkey % 4 = 3 AS INT) AS onsite FROM nat)
SELECT n_name, CASE WHEN bal < 4500 THEN 0 ELSE 3 * coalesce(grid, 0) + 2 * coalesce(fossil, 0) + 2 * coalesce(onsite, 0)
         + CASE r_name WHEN 'ASIA' THEN 2 WHEN 'EUROPE' THEN 1 ELSE 0 END END AS constraint_raw,
       CAST((grid IS NULL)::INT + (fossil IS NULL)::INT + (bal IS NULL)::INT AS BIGINT) AS null_count FROM f""",
)
def constraint_points_query(spark, sf):
    key = F.col("n_nationkey")
    rows = _nations(spark, sf).withColumns(
        {
            "grid": (key % 2 == 0).cast("int"),
            "fossil": F.when(key % 3 != 0, (key % 5 == 1).cast("int")),
            "onsite": (key % 4 == 3).cast("int"),
        }
    )
    raw = constraint_points("bal", 4500, {"grid": 3, "fossil": 2, "onsite": 2}, value_map("r_name", {"ASIA": 2, "EUROPE": 1}, 0))
    missing = indicator_count([F.col(c).isNull() for c in ("grid", "fossil", "bal")])
    return as_long(rows.select("n_name", raw.alias("constraint_raw"), missing.alias("null_count")), "constraint_raw", "null_count")


@query(
    "access_gap_flag",
    f"""WITH {_NATION_BASE_SQL},
s AS (SELECT n_name, CAST(ntile(5) OVER (ORDER BY bal NULLS FIRST, n_name) AS BIGINT) AS structure_score,
             CAST(ntile(5) OVER (ORDER BY n NULLS FIRST, n_name) AS BIGINT) AS access_score FROM nat)
SELECT *, structure_score - access_score >= 2 AS access_gap,
       CASE WHEN structure_score >= 4 THEN 'green' WHEN structure_score >= 2 THEN 'amber' ELSE 'red' END AS signal FROM s""",
)
def access_gap(spark, sf):
    rows = op.ntile_scores(_nations(spark, sf), {"structure_score": "bal", "access_score": "n"}, 5, ["n_name"])
    rows = as_long(rows.select("n_name", "structure_score", "access_score"), "structure_score", "access_score")
    return rows.withColumns(
        {
            "access_gap": access_gap_flag("structure_score", "access_score", 2),
            "signal": signal_tier("structure_score", [(4, "green"), (2, "amber")], "red"),
        }
    )


@query(
    "clean_non_finite",
    """SELECT event_type, count(*) AS n, count(v) AS known, round(CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE), 2) AS total
FROM (SELECT event_type, CASE WHEN event_id % 11 IN (1, 2, 3) THEN NULL ELSE value END AS v FROM events) GROUP BY event_type""",
)
def clean(spark, sf):
    slot = F.col("event_id") % 11
    dirty = rule_class(
        [(slot == 1, F.lit(float("nan"))), (slot == 2, F.lit(float("inf"))), (slot == 3, F.lit(float("-inf")))], None
    )
    rows = table(spark, sf, "events").withColumn("v", F.when(slot.isin(1, 2, 3), dirty).otherwise(F.col("value")))
    out = clean_non_finite(rows).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("v").alias("known"), F.sum(money("v")).alias("total")
    )
    return as_double(out, "total")
