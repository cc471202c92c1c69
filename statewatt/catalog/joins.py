"""Joins, updates, de-duplication, territories and names on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from statewatt import operators as op
from statewatt.catalog.registry import as_double, money, query, table
from statewatt.functions import in_years
from statewatt.sources import feature_filter, features_from_text

# --- joins ---------------------------------------------------------------------


def _m2m(spark, sf, fanout):
    items = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_partkey", "l_returnflag", money("l_quantity").alias("quantity"), money("l_extendedprice").alias("price")
    )
    left, right = items.filter(F.col("l_returnflag") != "R"), items.filter(F.col("l_returnflag") == "R")
    out = op.m2m_left_sums(
        left, right, ["l_suppkey", "l_partkey"], "l_suppkey", {"quantity": "kept_quantity"}, {"price": "returned_price"}, None, fanout
    )
    return as_double(out, "kept_quantity", "returned_price")


@query(
    "m2m_left_sums",
    """SELECT a.l_suppkey, CAST(sum(CAST(a.l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS kept_quantity,
       CAST(coalesce(sum(CAST(r.l_extendedprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS returned_price
FROM (SELECT * FROM lineitem WHERE l_returnflag <> 'R') a
LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') r ON a.l_suppkey = r.l_suppkey AND a.l_partkey = r.l_partkey
GROUP BY a.l_suppkey""",
)
def m2m_left_sums(spark, sf):
    return _m2m(spark, sf, "keep")


@query(
    "m2m_left_sums_dedup",
    """WITH a AS (SELECT l_suppkey, l_partkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL),
r AS (SELECT l_suppkey, l_partkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS p FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
SELECT l_suppkey, CAST(sum(q) AS DOUBLE) AS kept_quantity, CAST(coalesce(sum(p), 0) AS DOUBLE) AS returned_price
FROM a LEFT JOIN r USING (l_suppkey, l_partkey) GROUP BY l_suppkey""",
)
def m2m_left_sums_dedup(spark, sf):
    return _m2m(spark, sf, "dedup")


@query(
    "distinct_dim_join",
    """SELECT o_orderpriority, count(*) AS items, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
FROM lineitem JOIN (SELECT DISTINCT o_orderkey, o_orderpriority FROM orders) d ON l_orderkey = o_orderkey
WHERE year(l_shipdate) = 1998 AND o_orderpriority NOT IN ('5-LOW') GROUP BY o_orderpriority""",
)
def distinct_dim_join(spark, sf):
    items = table(spark, sf, "lineitem").filter(in_years("l_shipdate", 1998)).withColumnRenamed("l_orderkey", "o_orderkey")
    orders = table(spark, sf, "orders").filter(~F.col("o_orderpriority").isin("5-LOW"))
    aggs = [F.count(F.lit(1)).alias("items"), F.sum(money("l_quantity")).alias("quantity")]
    return as_double(op.dim_join_rollup(items, orders, "o_orderkey", "o_orderpriority", aggs), "quantity")


@query(
    "having_semi",
    """SELECT s_nationkey, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM supplier
GROUP BY s_nationkey HAVING s_nationkey IN (SELECT DISTINCT c_nationkey FROM customer WHERE c_acctbal > 9900)""",
)
def having_semi(spark, sf):
    rich = table(spark, sf, "customer").filter(F.col("c_acctbal") > 9900).select(F.col("c_nationkey").alias("s_nationkey"))
    kept = op.having_semi(table(spark, sf, "supplier"), "s_nationkey", rich)
    return as_double(kept.groupBy("s_nationkey").agg(F.sum(money("s_acctbal")).alias("balance")), "balance")


# --- updates -------------------------------------------------------------------


def _best_balance(spark, sf):
    """Best balance by nation; every third nation gets a key that no customer has."""
    nation = F.col("s_nationkey")
    key = F.when(nation % 3 == 0, nation + 100).otherwise(nation)
    return table(spark, sf, "supplier").groupBy(key.alias("c_nationkey")).agg(F.max("s_acctbal").alias("best"))


_BEST_SQL = """SELECT CASE WHEN s_nationkey % 3 = 0 THEN s_nationkey + 100 ELSE s_nationkey END AS key, max(s_acctbal) AS best FROM supplier GROUP BY ALL"""


@query(
    "lookup_update",
    f"SELECT c_custkey, CASE WHEN key IS NOT NULL THEN best ELSE c_acctbal END AS balance FROM customer LEFT JOIN ({_BEST_SQL}) ON c_nationkey = key",
)
def lookup_update(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.col("c_acctbal").alias("balance"))
    return op.lookup_update(rows, _best_balance(spark, sf), "c_nationkey", {"balance": F.col("best")}).select("c_custkey", "balance")


@query(
    "lookup_update_default",
    f"SELECT c_custkey, coalesce(best, 1.0) AS balance FROM customer LEFT JOIN ({_BEST_SQL}) ON c_nationkey = key",
)
def lookup_update_default(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.col("c_acctbal").alias("balance"))
    out = op.lookup_update(rows, _best_balance(spark, sf), "c_nationkey", {"balance": F.col("best")}, {"balance": 1})
    return out.select("c_custkey", "balance")


@query(
    "apply_overrides",
    """WITH o AS (SELECT n_name, arg_max(label, step) AS fix FROM (
  SELECT n_name, 'first' AS label, 1 AS step FROM nation WHERE n_regionkey IN (1, 2)
  UNION ALL SELECT n_name, 'second', 2 FROM nation WHERE n_regionkey = 2) GROUP BY n_name)
SELECT c_custkey, coalesce(fix, c_mktsegment) AS label FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN o USING (n_name)""",
)
def apply_overrides(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    rows = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select("c_custkey", "n_name", F.col("c_mktsegment").alias("label"))
    first = nation.filter(F.col("n_regionkey").isin(1, 2)).select("n_name", F.lit("first").alias("label"), F.lit(1).alias("step"))
    second = nation.filter(F.col("n_regionkey") == 2).select("n_name", F.lit("second").alias("label"), F.lit(2).alias("step"))
    return op.apply_overrides(rows, first.union(second), "n_name", "label", "step").select("c_custkey", "label")


# --- distinct, first, collapse, top ----------------------------------------------


@query(
    "distinct_mapping",
    """SELECT DISTINCT user_id, n_name FROM events LEFT JOIN customer ON user_id = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey WHERE user_id IS NOT NULL""",
)
def distinct_mapping(spark, sf):
    events, customer, nation = (table(spark, sf, t) for t in ("events", "customer", "nation"))
    users = op.distinct_mapping(events, "user_id")
    placed = users.join(customer, users.user_id == customer.c_custkey, "left")
    placed = placed.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return op.distinct_mapping(placed, "user_id", "n_name")


@query(
    "dedup_first",
    """SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
)
def dedup_first(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return op.dedup_first(events, "user_id", ["ts", "event_id"]).drop("ts")


@query(
    "dedup_collapse",
    """WITH o AS (SELECT *, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS p FROM orders)
SELECT o_custkey, arg_min(p, o_orderkey) FILTER (p IS NOT NULL) AS priority, arg_min(o_orderstatus, o_orderkey) AS status,
       CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS amount FROM o GROUP BY o_custkey""",
)
def dedup_collapse(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey",
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderstatus").alias("status"),
        money("o_totalprice").alias("amount"),
    )
    return as_double(op.dedup_collapse(orders, "o_custkey", ["priority", "status"], ["amount"], ["o_orderkey"]), "amount")


@query(
    "top_k",
    """SELECT o_custkey, CAST(amount AS DOUBLE) AS amount FROM (
  SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders GROUP BY o_custkey)
ORDER BY amount DESC, o_custkey LIMIT 10""",
)
def top_k(spark, sf):
    totals = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("amount"))
    return as_double(op.top_k(totals, "amount", 10, ["o_custkey"]), "amount")


# --- territories -----------------------------------------------------------------


def _ring(*vertices):
    return F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in vertices])


def _box(x, y, w, h):
    return _ring((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))


def _territories(spark, sf):
    """Per nation a box, a diamond, or a box with a hole plus a second box."""
    key, region = F.col("n_nationkey"), F.col("n_regionkey")
    x, y = key * 12, region * 8
    box = F.array(F.array(_box(x, y, 25, 40)))
    diamond = F.array(F.array(_ring((x - 16, y + 20), (x, y + 4), (x + 16, y + 20), (x, y + 36), (x - 16, y + 20))))
    parts = F.array(F.array(_box(x, y, 25, 40), _box(x + 5, y + 10, 10, 20)), F.array(_box(x + 30, y, 5, 90)))
    shape = F.when(key % 3 == 0, box).when(key % 3 == 1, diamond).otherwise(parts)
    return table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey", shape.alias("shape"))


_INSIDE_SQL = """places AS (SELECT c_custkey, c_acctbal, CAST(c_custkey % 360 AS DOUBLE) AS lon, c_acctbal / 100 AS lat FROM customer),
lands AS (SELECT n_nationkey, n_name, n_regionkey, n_nationkey * 12 AS x, n_regionkey * 8 AS y FROM nation),
pairs AS (
  SELECT c_custkey, n_nationkey, n_name, n_regionkey FROM places JOIN lands ON
    CASE n_nationkey % 3
      WHEN 0 THEN lon > x AND lon < x + 25 AND lat > y AND lat < y + 40
      WHEN 1 THEN abs(lon - x) + abs(lat - (y + 20)) < 16
      ELSE (lon > x AND lon < x + 25 AND lat > y AND lat < y + 40
            AND NOT (lon >= x + 5 AND lon <= x + 15 AND lat >= y + 10 AND lat <= y + 30))
        OR (lon > x + 30 AND lon < x + 35 AND lat > y AND lat < y + 90) END)"""


def _places(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", "c_acctbal", (F.col("c_custkey") % 360).cast("double").alias("lon"), (F.col("c_acctbal") / 100).alias("lat")
    )


def _located(spark, sf):
    return op.spatial_join(
        _places(spark, sf), _territories(spark, sf), "lon", "lat", "shape", ["n_nationkey", "n_name", "n_regionkey"]
    )


@query(
    "spatial_join_within",
    f"WITH {_INSIDE_SQL} SELECT c_custkey, n_name FROM customer LEFT JOIN pairs USING (c_custkey)",
)
def spatial_join_within(spark, sf):
    return _located(spark, sf).select("c_custkey", "n_name")


@query(
    "territory_rollup",
    f"""WITH {_INSIDE_SQL},
firsts AS (SELECT c_custkey, min(n_nationkey) AS n_nationkey FROM pairs GROUP BY c_custkey)
SELECT n_name, n_regionkey, count(c_custkey) AS facility_count,
       CAST(trunc(CAST(coalesce(sum(CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END), 0) AS DOUBLE)) AS BIGINT) AS area_total
FROM firsts JOIN nation USING (n_nationkey) JOIN customer USING (c_custkey) GROUP BY ALL""",
)
def territory_rollup(spark, sf):
    inside = _located(spark, sf).filter(F.col("n_name").isNotNull())
    first = op.dedup_first(inside, "c_custkey", ["n_nationkey"])
    first = first.withColumn("area", F.when(F.col("c_custkey") % 9 != 0, money("c_acctbal")))
    return op.territory_rollup(first, ["n_name", "n_regionkey"], "c_custkey", "area")


@query(
    "crs_normalise",
    """SELECT c_custkey, round(degrees(x / 6378137.0), 6) AS lon, round(degrees(2 * atan(exp(y / 6378137.0)) - pi() / 2), 6) AS lat
FROM (SELECT c_custkey, CAST((c_custkey % 360 - 180) * 100000 AS DOUBLE) AS x, c_acctbal * 1000 AS y FROM customer)""",
)
def crs_normalise(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", ((F.col("c_custkey") % 360 - 180) * 100000).cast("double").alias("lon"), (F.col("c_acctbal") * 1000).alias("lat")
    )
    out = op.normalise_crs(rows, 3857, "lon", "lat")
    return out.withColumns({"lon": F.round("lon", 6), "lat": F.round("lat", 6)})


@query(
    "geo_feature_filter",
    """SELECT c_custkey AS ordinal, c_name AS name, c_mktsegment AS state, CASE WHEN c_custkey % 2 = 0 THEN 'Polygon' ELSE 'MultiPolygon' END AS geometry_type,
       CAST(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END AS BIGINT) AS parts, CAST(c_custkey % 50 AS DOUBLE) AS first_x
FROM customer WHERE c_custkey % 4 IN (0, 1)""",
)
def geo_feature_filter(spark, sf):
    kind = F.when(F.col("c_custkey") % 4 == 0, "COOPERATIVE").when(F.col("c_custkey") % 4 == 1, "Cooperative").when(
        F.col("c_custkey") % 4 == 2, "INVESTOR OWNED"
    )
    ring = F.concat(F.lit("[["), F.col("c_custkey") % 50, F.lit(",0],["), F.col("c_custkey") % 50 + 1, F.lit(",0],[0,9.5],["), F.col("c_custkey") % 50, F.lit(",0]]"))
    simple = F.col("c_custkey") % 2 == 0
    text = F.concat(
        F.lit('{"type":"Feature","properties":'),
        F.to_json(F.struct(kind.alias("TYPE"), F.col("c_name").alias("NAME"), F.col("c_mktsegment").alias("STATE"))),
        F.when(simple, F.lit(',"geometry":{"type":"Polygon","coordinates":[')).otherwise(F.lit(',"geometry":{"type":"MultiPolygon","coordinates":[[')),
        ring,
        F.when(simple, F.lit("]}}")).otherwise(F.concat(F.lit("],["), ring, F.lit("]]}}"))),
    )
    rows = table(spark, sf, "customer").select("c_custkey", text.alias("feature"))
    properties = StructType().add("TYPE", StringType()).add("NAME", StringType()).add("STATE", StringType())
    kept = feature_filter(features_from_text(rows, "feature", "c_custkey", properties), "COOPERATIVE")
    return kept.select(
        "ordinal",
        F.col("properties.NAME").alias("name"),
        F.col("properties.STATE").alias("state"),
        "geometry_type",
        F.size("polygons").cast("long").alias("parts"),
        F.col("polygons")[0][0][0]["x"].alias("first_x"),
    )


# --- names ---------------------------------------------------------------------


def _names(spark, sf):
    """Part names, and as choices the same names with swapped words and a letter
    added, or with all letters reversed, which leaves some names unmatched;
    choices get the smallest part key as their place in the list."""
    part = table(spark, sf, "part")
    left = part.select("p_partkey", "p_name")
    words = F.split("p_name", " ")
    options = part.groupBy("p_name").agg(F.min("p_partkey").alias("place"))
    swapped = F.concat(F.get(words, F.lit(1)), F.lit("x "), F.get(words, F.lit(0)))
    return left, options.select(F.when(F.col("place") % 3 == 0, F.reverse("p_name")).otherwise(swapped).alias("choice"), "place")


def lcs_sql(a: str, b: str) -> str:
    """Longest common subsequence of two text expressions, row by row."""
    return f"""list_reduce(list_transform(string_split({b}, ''), lambda c: [unicode(c)]),
      lambda p, ch: list_reduce(list_transform(range(1, length({a}) + 1), lambda j: [CAST(j AS INTEGER)]),
        lambda acc, j: list_append(acc, CASE WHEN unicode(substr({a}, j[1], 1)) = ch[1] THEN p[j[1]] + 1
                                        ELSE greatest(p[j[1] + 1], acc[len(acc)]) END), [0]),
      list_transform(range(0, length({a}) + 1), lambda z: 0))[-1]"""


def sorted_tokens_sql(text: str) -> str:
    return f"array_to_string(list_sort(string_split({text}, ' ')), ' ')"


_NAMES_SQL = f"""names AS (SELECT DISTINCT upper(trim(p_name)) AS name, {sorted_tokens_sql('upper(trim(p_name))')} AS a FROM part),
options AS (SELECT CASE WHEN place % 3 = 0 THEN reverse(p_name) ELSE split_part(p_name, ' ', 2) || 'x ' || split_part(p_name, ' ', 1) END AS choice, place
  FROM (SELECT p_name, min(p_partkey) AS place FROM part GROUP BY p_name)),
choices AS (SELECT upper(choice) AS choice, place, {sorted_tokens_sql('upper(choice)')} AS b FROM options),
scored AS (SELECT name, choice, place, 200.0 * ({lcs_sql('a', 'b')}) / (length(a) + length(b)) AS score FROM names, choices),
hits AS (SELECT name, choice AS match, round(CAST(score AS DOUBLE), 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, place) AS rn FROM scored WHERE score >= 80) WHERE rn = 1)"""


def _matched(spark, sf):
    left, options = _names(spark, sf)
    return op.fuzzy_best_match(left, "p_name", options, "choice", "place", 80.0)


@query(
    "fuzzy_best_match",
    f"WITH {_NAMES_SQL} SELECT p_partkey, p_name, match, score FROM part LEFT JOIN hits ON upper(trim(p_name)) = name",
)
def fuzzy_best_match(spark, sf):
    return _matched(spark, sf).withColumn("score", F.round("score", 6))


@query(
    "match_report",
    f"""WITH {_NAMES_SQL},
m AS (SELECT DISTINCT p_name, match FROM part LEFT JOIN hits ON upper(trim(p_name)) = name)
SELECT p_name, match, CASE WHEN match IS NULL THEN 'unmatched' ELSE 'matched' END AS status,
       CASE WHEN match IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY match) END AS names_on_match FROM m""",
)
def match_report(spark, sf):
    return op.match_report(_matched(spark, sf), "p_name", "match")


@query(
    "attach_matches",
    f"""WITH {_NAMES_SQL},
m AS (SELECT match, count(*) AS facilities FROM part JOIN hits ON upper(trim(p_name)) = name GROUP BY match, p_name)
SELECT choice, CAST(coalesce(facilities, 0) AS BIGINT) AS facilities FROM options LEFT JOIN m ON upper(options.choice) = m.match""",
)
def attach_matches(spark, sf):
    left, options = _names(spark, sf)
    per_name = left.groupBy("p_name").agg(F.count(F.lit(1)).alias("facilities"))
    matched = op.fuzzy_best_match(per_name, "p_name", options, "choice", "place", 80.0)
    return op.attach_matches(options, "choice", matched, "match", ["facilities"]).select("choice", "facilities")
