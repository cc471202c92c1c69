"""Every model table as a query, with a plain SQL form of the same question.

The SQL joins, lags and ranks row by row; it shares no formula rewrite with
the Spark plans.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewatt.catalog.inputs import CLASSES, FUELS, OPERATORS, STATES, STRUCTURES, DerivedInputs, facility_inputs
from statewatt.catalog.joins import lcs_sql, sorted_tokens_sql
from statewatt.catalog.registry import query
from statewatt.plans import Models, config, facilities_in_territory, territory_report as run_report

# --- inputs in SQL -----------------------------------------------------------


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _case(col: str, mapping: dict, default: str = "NULL") -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + f" ELSE {default} END"


def _listed(col: str, lists: list[tuple[list[str], int]], default: int) -> str:
    return "CASE " + " ".join(f"WHEN {col} IN {_in(values)} THEN {score}" for values, score in lists) + f" ELSE {default} END"


def _state(key: str) -> str:
    return f"({_list(STATES)})[CAST({key} AS BIGINT) + 1]"


def _day(col: str, unit: str) -> str:
    return f"CAST(date_trunc('{unit}', {col}) + INTERVAL 24 YEAR AS DATE)"


_OLD_FUEL = _case("o_orderpriority", FUELS, "CASE WHEN o_orderstatus = 'P' THEN 'hydro' ELSE 'oil' END")
_FUEL = f"CASE WHEN o_orderkey % 97 <> 0 THEN {_OLD_FUEL} END"

_CTES: dict[str, str] = {
    "gen": f"SELECT o_custkey AS plant, {_day('o_orderdate', 'month')} AS day, {_FUEL} AS fuel, floor(o_totalprice) AS mwh FROM orders",
    "ops": f"""SELECT o_custkey AS plant, {_day('o_orderdate', 'month')} AS day,
  CASE WHEN l_orderkey % 101 <> 0 THEN {_state('(c_nationkey + CAST(l_linenumber = 7 AS INT)) % 25')} END AS state, {_FUEL} AS fuel,
  round(l_discount * 100) AS cf, CASE WHEN o_custkey % 20 <> 13 THEN 'BA' || ((c_nationkey * 5 + o_custkey % 3) % 29) END AS ba
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "hours": """SELECT * FROM (SELECT CASE WHEN user_id % 20 <> 17 THEN 'BA' || (user_id % 20) END AS ba,
  ts - to_months(CAST(event_id % 80 AS INT)) AS tick, CASE WHEN event_id % 53 <> 0 THEN v * 3 END AS g,
  CASE WHEN event_id % 59 <> 0 THEN v * 2 + event_id % 11 END AS d, event_id % 13 * 5 - v AS x FROM (SELECT *, round(value * 100) AS v FROM events))
  WHERE tick >= TIMESTAMP '2019-01-01'""",
    "receipts": f"""SELECT CASE WHEN l_orderkey % 103 <> 0 THEN {_state('s_nationkey')} END AS state,
  CASE WHEN l_returnflag = 'N' AND s_nationkey % 5 = 0 THEN 'wood' ELSE {_case('l_returnflag', {'A': 'gas', 'N': 'coal', 'R': 'oil'})} END AS fuel,
  {_day('l_shipdate', 'month')} AS day, floor(l_extendedprice) AS cost, l_quantity AS burnt,
  CASE WHEN l_linenumber <> 3 AND NOT (s_nationkey % 6 = 0 AND l_linenumber < 6) THEN floor(l_extendedprice) / l_quantity END AS unit
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "sales": f"""SELECT {_state('c_nationkey')} AS state, year(o_orderdate) + 24 AS yr, {_case('c_mktsegment', CLASSES, "'commercial'")} AS cls,
  o_orderpriority = '5-LOW' AS coop, o_orderkey % 1000 + 1 AS customers, floor(o_totalprice) AS mwh,
  floor(o_totalprice) * (o_orderkey % 7 + 1) AS revenue FROM orders JOIN customer ON o_custkey = c_custkey""",
    "outages": f"""SELECT {_state('c_nationkey')} AS state, year(o_orderdate) + 24 AS yr, floor(o_totalprice / 1000) AS minutes, o_orderkey % 500 AS customers
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' AND o_orderkey % 13 <> 0""",
    "saved": f"""SELECT CASE WHEN l_returnflag = 'R' AND l_suppkey % 9 = 0 THEN -l_suppkey ELSE l_suppkey END AS utility, {_state('s_nationkey')} AS state, year(l_shipdate) + 24 AS yr, l_returnflag AS kind, l_quantity AS mwh,
  l_linenumber AS mw FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "units": """SELECT o_custkey AS plant, year(o_orderdate) + 24 AS yr, floor(o_totalprice / 1000) AS mw, CAST(o_orderkey % 2 = 0 AS INT) AS f1,
  CAST(o_orderkey % 3 = 0 AS INT) AS f2, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 5 = 0 AS INT) END AS f3, CAST(NULL AS INT) AS f4,
  CAST(o_orderstatus = 'F' AS INT) AS f5 FROM orders""",
    "centers": f"""SELECT {_state('n_nationkey')} AS state, n_nationkey AS k, n_name, count(c_custkey) AS sites,
  CASE WHEN n_nationkey % 11 <> 10 THEN sum(floor(c_acctbal)) / 500000 END AS twh, CASE WHEN n_nationkey % 7 <> 0 THEN n_nationkey % 8 * 0.95::DOUBLE END AS usd,
  n_nationkey * 22 AS mw, n_nationkey % 2 AS f1, CASE WHEN n_nationkey % 3 <> 0 THEN CAST(n_nationkey % 5 = 1 AS INT) END AS f2,
  CAST(n_nationkey % 4 = 3 AS INT) AS f3 FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY n_nationkey, n_name""",
    "market": f"""SELECT {_state('n_nationkey')} AS state, ({_list(OPERATORS)})[n_nationkey % 7 + 1] AS iso, ({_list(STRUCTURES)})[n_nationkey % 3 + 1] AS kind,
  CASE WHEN n_nationkey % 9 <> 8 THEN n_nationkey * 2.5 END AS choice FROM nation""",
    "offers": f"SELECT CASE WHEN n_nationkey % 6 = 5 THEN 'not ' ELSE '' END || {_state('n_nationkey')} AS state, CAST(n_nationkey % 5 + 0.5 AS DECIMAL(5,2)) AS points FROM nation",
}

# --- model tables in SQL -------------------------------------------------------

_RE, _VRE, _FOS = _in(config.RENEWABLE), _in(config.VARIABLE_RENEWABLE), _in(config.FOSSIL)
_FAR = _in(config.NON_CONTIGUOUS)


_PCT_OF = {
    "early_variable_re_share": "early_variable_re_pct",
    "late_variable_re_share": "late_variable_re_pct",
    "variable_re_growth": "variable_re_growth_pct",
    "early_total_re_share": "early_total_re_pct",
    "late_total_re_share": "late_total_re_pct",
    "total_re_growth": "total_re_growth_pct",
    "early_fossil_share": "early_fossil_pct",
    "late_fossil_share": "late_fossil_pct",
    "fossil_share_change": "fossil_change_pct",
}


def _cv(v: str, base: str | None = None) -> str:
    return f"stddev_pop({v}) / nullif(avg({base or v}), 0)"


def _five(col: str, source: str = "") -> str:
    return f"ntile(5) OVER (ORDER BY {source}{col} NULLS FIRST, {source}state)"


def _exact(total: str, by: str) -> str:
    return f"round(CAST({total} AS DECIMAL(18,4)) / {by}, 2)"


def _ramp(v: str, key: str, std: str) -> str:
    return f"avg({v}) AS avg_{key}_mwh, max({v}) AS max_{key}_mwh, {std}({v}) AS std_dev_{key}_mwh"


_CTES |= {
    "a_base": """SELECT state, gen.fuel AS fuel_type_code_pudl, strftime(day, '%Y-%m') AS period, sum(mwh) AS monthly_gen_mwh
  FROM gen JOIN ops USING (plant, day) WHERE day >= DATE '2019-01-01' AND state IS NOT NULL GROUP BY ALL""",
    "a_vol": f"""SELECT state, fuel_type_code_pudl, sum(monthly_gen_mwh) AS total_gen_mwh, avg(monthly_gen_mwh) AS avg_monthly_gen_mwh,
  max(monthly_gen_mwh) AS max_monthly_gen_mwh, min(monthly_gen_mwh) AS min_monthly_gen_mwh, stddev_pop(monthly_gen_mwh) AS std_dev_gen_mwh,
  max(monthly_gen_mwh) - min(monthly_gen_mwh) AS range_gen_mwh, {_cv('monthly_gen_mwh')} AS coefficient_of_variation FROM a_base GROUP BY ALL""",
    "a_tot": f"""SELECT state, sum(total_gen_mwh) AS t, coalesce(sum(total_gen_mwh) FILTER (fuel_type_code_pudl IN {_RE}), 0) AS r,
  coalesce(sum(total_gen_mwh) FILTER (fuel_type_code_pudl IN {_VRE}), 0) AS v, coalesce(sum(total_gen_mwh) FILTER (fuel_type_code_pudl IN {_FOS}), 0) AS f
  FROM a_vol GROUP BY state""",
    "a_cap": "SELECT state, fuel AS fuel_type_code_pudl, avg(cf) AS avg_capacity_factor FROM ops WHERE day >= DATE '2019-01-01' GROUP BY ALL",
    "a_month": """SELECT a_vol.*, total_gen_mwh / t AS fuel_share, r / t AS renewable_share, v / t AS variable_renewable_share, f / t AS fossil_share,
  avg_capacity_factor FROM a_vol JOIN a_tot USING (state) LEFT JOIN a_cap USING (state, fuel_type_code_pudl) WHERE fuel_type_code_pudl IS NOT NULL""",
    "ba_map": "SELECT DISTINCT ba AS balancing_authority_code_eia, state FROM ops WHERE ba IS NOT NULL",
    "steps": """SELECT ba, lag(g) OVER w AS pg, abs(g - lag(g) OVER w) AS sg, abs(d - lag(d) OVER w) AS sd, abs(x - lag(x) OVER w) AS sx
  FROM hours WINDOW w AS (PARTITION BY ba ORDER BY tick)""",
    "ramp_g": f"SELECT ba AS balancing_authority_code_eia, {_ramp('sg', 'ramp_rate', 'stddev_pop')} FROM steps WHERE pg IS NOT NULL GROUP BY ba",
    "ramp_dx": f"""SELECT ba AS balancing_authority_code_eia, {_ramp('sd', 'demand_ramp', 'stddev_samp')}, {_ramp('sx', 'interchange_ramp', 'stddev_samp')}
  FROM steps WHERE ba IS NOT NULL GROUP BY ba""",
    "a_prof": f"""SELECT ba AS balancing_authority_code_eia, avg(g) AS avg_hourly_gen_mwh, stddev_pop(g) AS std_dev_gen_mwh, max(g) AS max_hourly_gen_mwh,
  min(g) AS min_hourly_gen_mwh, max(g) - min(g) AS range_gen_mwh, {_cv('g')} AS cv_gen, avg(d) AS avg_hourly_demand_mwh, stddev_pop(d) AS std_dev_demand_mwh,
  max(d) AS max_hourly_demand_mwh, min(d) AS min_hourly_demand_mwh, {_cv('d')} AS cv_demand, avg(g - d) AS avg_gap_mwh, stddev_pop(g - d) AS std_dev_gap_mwh,
  max(g - d) AS max_surplus_mwh, min(g - d) AS max_deficit_mwh, {_cv('g - d', 'd')} AS cv_gap, avg(x) AS avg_interchange_mwh,
  stddev_pop(x) AS std_dev_interchange_mwh, max(x) AS max_interchange_mwh, min(x) AS min_interchange_mwh, {_cv('x')} AS cv_interchange FROM hours GROUP BY ba""",
    "a_hour": """SELECT *, CAST(avg_hourly_gen_mwh IS NULL AS BIGINT) + CAST(avg_hourly_demand_mwh IS NULL AS BIGINT) + CAST(avg_gap_mwh IS NULL AS BIGINT)
  + CAST(avg_ramp_rate_mwh IS NULL AS BIGINT) + CAST(avg_demand_ramp_mwh IS NULL AS BIGINT) AS null_count
  FROM a_prof LEFT JOIN ramp_g USING (balancing_authority_code_eia) LEFT JOIN ramp_dx USING (balancing_authority_code_eia)""",
}

_MEAN_COLS = [
    "avg_hourly_gen_mwh",
    "avg_hourly_demand_mwh",
    "avg_gap_mwh",
    "avg_interchange_mwh",
    "avg_ramp_rate_mwh",
    "avg_demand_ramp_mwh",
    "avg_interchange_ramp_mwh",
    "std_dev_gen_mwh",
    "std_dev_demand_mwh",
    "std_dev_gap_mwh",
    "std_dev_interchange_mwh",
    "std_dev_ramp_rate_mwh",
    "std_dev_demand_ramp_mwh",
    "std_dev_interchange_ramp_mwh",
]
_MAX_COLS = [
    "max_hourly_gen_mwh",
    "max_hourly_demand_mwh",
    "max_surplus_mwh",
    "max_interchange_mwh",
    "max_ramp_rate_mwh",
    "max_demand_ramp_mwh",
    "max_interchange_ramp_mwh",
]
_MIN_COLS = ["min_hourly_gen_mwh", "min_hourly_demand_mwh", "max_deficit_mwh", "min_interchange_mwh"]
_W = "avg_hourly_gen_mwh"
_CTES |= {
    "a2_sums": "SELECT state, "
    + ", ".join(f"sum({m} * {_W}) / nullif(sum({_W}), 0) AS {m}" for m in _MEAN_COLS)
    + ", "
    + ", ".join(f"max({m}) AS {m}" for m in _MAX_COLS)
    + ", "
    + ", ".join(f"min({m}) AS {m}" for m in _MIN_COLS)
    + ", min(null_count) AS min_null_count FROM a_hour JOIN ba_map USING (balancing_authority_code_eia) WHERE state IS NOT NULL GROUP BY state",
    "a2": """SELECT *, max_hourly_gen_mwh - min_hourly_gen_mwh AS range_gen_mwh, std_dev_gen_mwh / nullif(avg_hourly_gen_mwh, 0) AS cv_gen,
  std_dev_demand_mwh / nullif(avg_hourly_demand_mwh, 0) AS cv_demand, std_dev_gap_mwh / nullif(avg_hourly_demand_mwh, 0) AS cv_gap FROM a2_sums""",
    "b_base": """SELECT state, fuel AS fuel_type_code_pudl, strftime(day, '%Y-%m') AS period, sum(cost) / nullif(sum(burnt), 0) AS avg_cost_per_mmbtu,
  min(unit) AS min_cost_per_mmbtu, max(unit) AS max_cost_per_mmbtu, sum(burnt) AS total_fuel_consumed_mmbtu, sum(cost) AS total_fuel_cost,
  count(*) AS record_count, count(*) FILTER (unit IS NULL) AS null_cost_count
  FROM receipts WHERE day >= DATE '2019-01-01' AND state IS NOT NULL GROUP BY ALL""",
    "b_cost": """SELECT *, round(CAST(null_cost_count AS DECIMAL(18,1)) * 100 / record_count, 1) AS null_pct,
  h AS benchmark_heat_rate, avg_cost_per_mmbtu * h AS est_cost_per_mwh
  FROM (SELECT *, CASE fuel_type_code_pudl WHEN 'gas' THEN 7.0::DOUBLE WHEN 'coal' THEN 10.5 WHEN 'oil' THEN 11.0 END AS h FROM b_base)
  WHERE avg_cost_per_mmbtu IS NOT NULL""",
    "b_stat": f"""SELECT state, fuel_type_code_pudl, count(*) AS month_count, round(avg(c), 2) AS avg_cost_per_mwh, round(min(c), 2) AS min_cost_per_mwh,
  round(max(c), 2) AS max_cost_per_mwh, round(stddev_pop(c), 2) AS std_dev_cost_per_mwh, round(max(c) - min(c), 2) AS cost_range_per_mwh,
  round({_cv('c')}, 4) AS cv_cost, round(avg(null_pct), 1) AS avg_null_pct, CAST(avg(null_pct) >= 40 AS BIGINT) AS high_null_flag
  FROM (SELECT *, est_cost_per_mwh AS c FROM b_cost) WHERE c > 0 GROUP BY ALL""",
    "b_spread": """SELECT g.state, g.avg_cost_per_mwh AS gas_avg_cost_per_mwh, k.avg_cost_per_mwh AS coal_avg_cost_per_mwh, o.avg_cost_per_mwh AS oil_avg_cost_per_mwh,
  round(g.avg_cost_per_mwh - k.avg_cost_per_mwh, 2) AS gas_coal_spread, round(g.avg_cost_per_mwh - o.avg_cost_per_mwh, 2) AS gas_oil_spread,
  round(o.avg_cost_per_mwh - k.avg_cost_per_mwh, 2) AS oil_coal_spread,
  CASE WHEN 1 IN (coalesce(g.high_null_flag, 0), coalesce(k.high_null_flag, 0), coalesce(o.high_null_flag, 0)) THEN 1 ELSE 0 END AS any_high_null_flag
  FROM (SELECT * FROM b_stat WHERE fuel_type_code_pudl = 'gas') g LEFT JOIN (SELECT * FROM b_stat WHERE fuel_type_code_pudl = 'coal') k USING (state)
  LEFT JOIN (SELECT * FROM b_stat WHERE fuel_type_code_pudl = 'oil') o USING (state)""",
    "c_conc": """SELECT state, round(sum(fuel_share ** 2), 4) AS hhi_concentration, count(fuel_type_code_pudl) AS fuel_type_count,
  max(fuel_share) AS dominant_fuel_share, arg_max(fuel_type_code_pudl, (fuel_share, fuel_type_code_pudl)) AS dominant_fuel_type FROM a_month GROUP BY state""",
    "c_year": f"""SELECT state, left(period, 4) AS yr, sum(monthly_gen_mwh) AS t, coalesce(sum(monthly_gen_mwh) FILTER (fuel_type_code_pudl IN {_VRE}), 0) AS v,
  coalesce(sum(monthly_gen_mwh) FILTER (fuel_type_code_pudl IN {_RE}), 0) AS r, coalesce(sum(monthly_gen_mwh) FILTER (fuel_type_code_pudl IN {_FOS}), 0) AS f
  FROM a_base GROUP BY ALL""",
    "c_half": """SELECT state, CASE WHEN yr <= '2021' THEN 'early' ELSE 'late' END AS half, avg(round(v / nullif(t, 0), 4)) AS v,
  avg(round(r / nullif(t, 0), 4)) AS r, avg(round(f / nullif(t, 0), 4)) AS f FROM c_year WHERE yr BETWEEN '2019' AND '2024' GROUP BY ALL""",
    "c_trend": """SELECT e.state, round(e.v, 4) AS early_variable_re_share, round(l.v, 4) AS late_variable_re_share, round(l.v - e.v, 4) AS variable_re_growth,
  round(e.r, 4) AS early_total_re_share, round(l.r, 4) AS late_total_re_share, round(l.r - e.r, 4) AS total_re_growth,
  round(e.f, 4) AS early_fossil_share, round(l.f, 4) AS late_fossil_share, round(l.f - e.f, 4) AS fossil_share_change
  FROM c_half e JOIN c_half l ON e.state = l.state AND e.half = 'early' AND l.half = 'late'""",
    "c_sum": f"""SELECT state, hhi_concentration, fuel_type_count, dominant_fuel_type, round(dominant_fuel_share * 100, 1) AS dominant_fuel_pct,
  {', '.join(f'round(CAST({a} AS DECIMAL(9,4)) * 100, 1) AS {b}' for a, b in _PCT_OF.items())},
  CASE WHEN variable_re_growth >= {config.RAPID_GROWTH} AND fossil_share_change < 0 THEN 'rapid_transition'
       WHEN variable_re_growth >= {config.MODERATE_GROWTH} AND fossil_share_change < 0 THEN 'moderate_transition'
       WHEN variable_re_growth >= {config.MODERATE_GROWTH} AND fossil_share_change >= 0 THEN 'renewable_adding_not_replacing'
       WHEN variable_re_growth < {config.MODERATE_GROWTH} AND fossil_share_change < 0 THEN 'slow_transition' ELSE 'fossil_entrenched' END AS transition_status,
  CASE WHEN hhi_concentration >= {config.HIGH_CONCENTRATION} THEN 'highly_concentrated' WHEN hhi_concentration >= {config.MODERATE_CONCENTRATION} THEN 'moderately_concentrated' ELSE 'diversified' END
    AS concentration_class FROM c_conc JOIN c_trend USING (state)""",
    "c_fuel": "SELECT state, fuel_type_code_pudl, round(total_gen_mwh, 0) AS total_fuel_gen_mwh, fuel_share FROM a_month",
    "d_ind": f"""SELECT state, round(i, 0) AS industrial_mwh, round(t, 0) AS total_mwh, round(i / nullif(t, 0) * 100, 2) AS industrial_pct FROM (
  SELECT state, coalesce(sum(mwh) FILTER (cls = 'industrial'), 0) AS i, coalesce(sum(mwh) FILTER (cls IN {_in(config.CUSTOMER_CLASSES)}), 0) AS t
  FROM sales WHERE yr = 2024 AND state NOT IN {_FAR} GROUP BY state)""",
    "d_sto": f"""SELECT state, count(*) AS storage_units, round(sum(mw), 0) AS total_discharge_mw, sum(f1) AS units_arbitrage, sum(f2) AS units_freq_reg,
  sum(f3) AS units_peak_shaving, sum(f4) AS units_backup_power, sum(f5) AS units_spinning_reserve,
  coalesce(sum(f1), 0) + coalesce(sum(f2), 0) + coalesce(sum(f3), 0) + coalesce(sum(f4), 0) + coalesce(sum(f5), 0) AS total_use_case_activations
  FROM units JOIN (SELECT DISTINCT plant, state FROM ops) USING (plant) WHERE yr = 2024 AND state NOT IN {_FAR} GROUP BY state""",
    "d_rel": f"""SELECT state, round(sum(minutes * customers) / nullif(sum(customers), 0), 1) AS saidi_weighted_avg, sum(customers) AS total_customers,
  count(DISTINCT yr) AS years_covered FROM outages WHERE customers > 0 AND yr BETWEEN 2019 AND 2024 AND state NOT IN {_FAR} GROUP BY state""",
    "d_reg": f"""SELECT e.state, round(sum(e.mwh), 0) AS ee_savings_mwh, round(sum(e.mw), 0) AS ee_peak_reduction_mw,
  coalesce(round(sum(r.mw), 0), 0) AS dr_peak_reduction_mw, coalesce(round(sum(r.mwh), 0), 0) AS dr_savings_mwh
  FROM saved e LEFT JOIN saved r ON e.state = r.state AND e.yr = r.yr AND e.utility = r.utility AND r.kind = 'R'
  WHERE e.kind = 'A' AND e.yr = 2024 AND e.state NOT IN {_FAR} GROUP BY e.state""",
    "coops": """SELECT state, round(pc * 100, 1) AS cooperative_customer_pct, round(pm * 100, 1) AS cooperative_mwh_pct, saidi_weighted_avg FROM (
  SELECT state, coalesce(sum(customers) FILTER (coop), 0) / sum(customers) AS pc, coalesce(sum(mwh) FILTER (coop), 0) / nullif(sum(mwh), 0) AS pm
  FROM sales WHERE yr = 2024 AND state <> 'US' GROUP BY state HAVING sum(customers) > 0) JOIN d_rel USING (state)""",
    "i_base": """SELECT a2.state, cv_gen, cv_demand, avg_ramp_rate_mwh, max_ramp_rate_mwh, avg_demand_ramp_mwh, max_demand_ramp_mwh, avg_interchange_mwh,
  max_deficit_mwh, fossil_share, renewable_share, variable_renewable_share, g.avg_cost_per_mwh AS gas_avg_cost_per_mwh, g.cv_cost AS gas_cv_cost,
  g.high_null_flag AS gas_high_null_flag, o.avg_cost_per_mwh AS oil_avg_cost_per_mwh, o.cv_cost AS oil_cv_cost, gas_coal_spread, oil_coal_spread,
  hhi_concentration, dominant_fuel_type, dominant_fuel_pct, variable_re_growth_pct, late_fossil_pct, late_variable_re_pct, transition_status, concentration_class,
  CAST(NULL AS VARCHAR) AS market_structure, CAST(NULL AS VARCHAR) AS iso_rto, CAST(NULL AS BIGINT) AS industrial_load_score, CAST(NULL AS DOUBLE) AS incentive_score
  FROM a2 JOIN (SELECT DISTINCT state, fossil_share, renewable_share, variable_renewable_share FROM a_month) m ON a2.state = m.state
  JOIN c_sum ON c_sum.state = a2.state LEFT JOIN b_stat g ON g.state = a2.state AND g.fuel_type_code_pudl = 'gas'
  LEFT JOIN b_stat o ON o.state = a2.state AND o.fuel_type_code_pudl = 'oil' LEFT JOIN b_spread s ON s.state = a2.state""",
    "i_rank": "SELECT *, "
    + ", ".join(
        f"{_five(col)} AS {out}"
        for out, col in {
            "n1": "cv_gen",
            "n2": "cv_demand",
            "n3": "avg_ramp_rate_mwh",
            "n4": "avg_demand_ramp_mwh",
            "n5": "gas_cv_cost",
            "n6": "fossil_share",
            "n7": "hhi_concentration",
            "n8": "late_fossil_pct",
            "n9": "variable_re_growth_pct",
            "n10": "late_variable_re_pct",
        }.items()
    )
    + " FROM i_base",
    "i_score": f"""SELECT i.* EXCLUDE (industrial_load_score, incentive_score, market_structure, iso_rto), {_exact('n1 + n2 + n3 + n4', '4.0')} AS grid_stress_score,
  n5 AS cost_volatility_score, {_exact('n6 + n7', '2.0')} AS fossil_dependency_score, {_exact('n8 + n9 + n5', '3.0')} AS fossil_backup_dependency_score,
  {_exact('n9 + n10', '2.0')} AS transition_opportunity_score,
  CASE WHEN k.state IS NULL THEN NULL WHEN iso = 'ERCOT' THEN 5
       WHEN kind = 'deregulated' AND iso <> 'non_ISO' THEN 5 WHEN kind = 'restricted' AND iso <> 'non_ISO' THEN 4 WHEN kind = 'regulated' AND iso <> 'non_ISO' THEN 3
       WHEN kind = 'restricted' AND iso = 'non_ISO' THEN 3 WHEN kind = 'regulated' AND iso = 'non_ISO' THEN 2 ELSE 2 END AS market_structure_score,
  d.n AS industrial_load_score, coalesce(t.n, 1) AS storage_deployment_score, r.n AS reliability_score, e.n AS regulatory_receptiveness_score,
  CAST(points AS DOUBLE) AS incentive_score
  FROM i_rank i LEFT JOIN market k USING (state) LEFT JOIN (SELECT state, {_five('industrial_pct')} AS n FROM d_ind) d USING (state)
  LEFT JOIN (SELECT state, {_five('total_discharge_mw')} AS n FROM d_sto) t USING (state)
  LEFT JOIN (SELECT state, {_five('saidi_weighted_avg')} AS n FROM d_rel) r USING (state)
  LEFT JOIN (SELECT state, {_five('ee_savings_mwh')} AS n FROM d_reg) e USING (state) LEFT JOIN offers USING (state)""",
    "access": f"""SELECT state, {_listed('state', config.RESIDENTIAL_ACCESS, config.RESIDENTIAL_ACCESS_DEFAULT)} AS residential_access_score,
  {_listed('iso', config.WHOLESALE_COMPLEXITY, config.WHOLESALE_COMPLEXITY_DEFAULT)} AS wholesale_complexity_score, choice, iso, kind FROM market""",
    "e_mkt": f"""SELECT state, round(sum(customers), 0) AS residential_customers, round(sum(mwh), 0) AS residential_mwh, round(sum(revenue), 0) AS residential_revenue,
  round(sum(revenue) / nullif(sum(mwh), 0), 2) AS avg_retail_price_per_mwh, round(sum(mwh) / nullif(sum(customers), 0), 2) AS avg_mwh_per_customer
  FROM sales WHERE yr = 2024 AND cls = 'residential' AND state NOT IN {_FAR} GROUP BY state""",
    "e_join": f"""SELECT *, {_five('avg_retail_price_per_mwh')} AS residential_price_score, {_five('residential_customers')} AS residential_market_size_score,
  {_five('avg_mwh_per_customer')} AS residential_consumption_score
  FROM e_mkt JOIN (SELECT state, reliability_score, market_structure_score FROM i_score) i USING (state) JOIN access USING (state)""",
    "e_score": f"""SELECT *, {_exact('residential_price_score + residential_market_size_score + residential_consumption_score + reliability_score + market_structure_score + residential_access_score + wholesale_complexity_score', '7.0')}
  AS residential_composite_score FROM e_join""",
    "f_raw": """SELECT c.*, coalesce(f1, 0) + coalesce(f2, 0) + coalesce(f3, 0) AS flags, CASE WHEN twh < 0.5 THEN 0 ELSE coalesce(f1, 0) * 3 + coalesce(f2, 0) * 2
  + coalesce(f3, 0) * 2 + CASE WHEN iso = 'PJM' THEN 2 WHEN iso IN ('MISO', 'ISO_NE', 'NYISO') THEN 1 ELSE 0 END END AS raw
  FROM centers c JOIN market USING (state)""",
    "f_dc": f"""SELECT state, sites AS dc_facilities, twh AS dc_twh_per_year, k * 3 AS dc_inventory_mw, usd AS dc_announced_investment_usd_b,
  f1 AS dc_grid_constraint_flag, f2 AS dc_fossil_delay_flag, f3 AS dc_onsite_gen_flag, n_name AS major_hubs, n_name || ' operators' AS major_operators,
  CASE {' '.join(f"WHEN state = '{s}' THEN '{flag}'" for s, flag in config.GROWTH_OVERRIDES)} WHEN coalesce(usd, 0) >= 5 OR mw >= 500 OR flags >= 2 THEN 'High'
       WHEN coalesce(usd, 0) BETWEEN 1 AND 4.9 OR flags = 1 THEN 'Medium' ELSE 'Low' END AS dc_growth_flag,
  n1 AS dc_capacity_score, n2 AS dc_facilities_score, n3 AS dc_power_constraint_score, {_exact('n1 + n2 + n3', '3.0')} AS dc_composite_score
  FROM (SELECT *, {_five('twh')} AS n1, {_five('sites')} AS n2, {_five('raw')} AS n3 FROM f_raw)""",
    "f_sum": "SELECT state, "
    + ", ".join(
        f"coalesce(sum({m}) FILTER (cls IN {_in(cs)}), 0) AS {n}_{m}"
        for n, cs in (("commercial", ["commercial"]), ("industrial", ["industrial"]), ("ci", config.BUSINESS_CLASSES))
        for m in ("customers", "mwh", "revenue")
    )
    + " FROM sales WHERE yr = 2024 AND state <> 'US' GROUP BY state HAVING state IN (SELECT state FROM i_score)",
    "f_mkt": "SELECT *, "
    + ", ".join(
        f"CASE WHEN {n}_mwh > 0 THEN {n}_revenue / {n}_mwh END AS avg_{n}_price_per_mwh, "
        f"CASE WHEN {n}_customers > 0 THEN {n}_mwh / {n}_customers END AS avg_mwh_per_{n}_customer"
        for n in ("commercial", "industrial", "ci")
    )
    + " FROM f_sum",
    "f_join": f"""SELECT *, {_five('avg_ci_price_per_mwh')} AS ci_price_score, {_five('ci_customers')} AS ci_market_size_score,
  {_five('avg_mwh_per_ci_customer')} AS ci_consumption_score,
  CASE WHEN choice >= 50 THEN 5 WHEN choice >= 30 THEN 4 WHEN choice >= 15 THEN 3 WHEN choice >= 5 THEN 2 ELSE 1 END AS ci_access_score
  FROM f_mkt JOIN (SELECT state, reliability_score FROM i_score) i USING (state) JOIN market USING (state)
  JOIN (SELECT state, dc_composite_score AS dc_opportunity_score, dc_growth_flag FROM f_dc) d USING (state)""",
    # in whole hundredths, since DuckDB divides decimals as doubles and a half could round down
    "f_score": """SELECT *, CASE WHEN reliability_score IS NOT NULL THEN CAST(floor((CAST(round(dc_opportunity_score * 100) AS BIGINT)
  + 100 * (ci_price_score + ci_market_size_score + ci_consumption_score + reliability_score + ci_access_score)) / 6.0 + 0.5) AS DOUBLE) / 100 END
  AS ci_composite_score FROM f_join""",
}

_GRID = [
    "grid_stress_score",
    "cost_volatility_score",
    "fossil_dependency_score",
    "fossil_backup_dependency_score",
    "transition_opportunity_score",
    "market_structure_score",
    "industrial_load_score",
    "storage_deployment_score",
    "reliability_score",
    "regulatory_receptiveness_score",
    "incentive_score",
]
_GRID_SUM = " + ".join(f"coalesce(CAST({d} AS DECIMAL(18,4)), 0)" for d in _GRID)
_CTES |= {
    "final_g": f"""SELECT *, round(total / 11.0, 2) AS composite_score, rank() OVER (ORDER BY total DESC) AS opportunity_rank
  FROM (SELECT *, {_GRID_SUM} AS total FROM i_score)""",
    "final_r": """SELECT *, rank() OVER (ORDER BY residential_composite_score DESC NULLS LAST) AS opportunity_rank,
  CASE WHEN wholesale_complexity_score >= 3 AND residential_access_score >= 4 THEN 'Direct Retail Model'
       WHEN wholesale_complexity_score >= 3 AND residential_access_score = 3 THEN 'Direct Retail — Limited Access'
       WHEN residential_access_score = 2 THEN 'C&I Access Only — Partnership for Residential' ELSE 'Utility Partnership Only' END AS business_model FROM e_score""",
    "final_c": """SELECT *, rank() OVER (ORDER BY ci_composite_score DESC NULLS LAST) AS opportunity_rank,
  CASE WHEN dc_opportunity_score >= 4 THEN CASE WHEN ci_access_score >= 3 THEN 'Direct C&I + Data Center Partnership' ELSE 'Data Center Partnership' END
       WHEN ci_access_score >= 3 THEN 'Direct C&I Model' WHEN dc_growth_flag = 'High' THEN 'Utility Partnership — Data Center Pipeline'
       ELSE 'Utility Partnership Only' END AS business_model FROM f_score""",
}

# --- registration ----------------------------------------------------------------

# table -> (SQL form, text columns, whole-number columns, other numeric columns)
_KEYS = ["state", "fuel_type_code_pudl"]
_SHARES = ["fuel_share", "renewable_share", "variable_renewable_share", "fossil_share"]
_HOUR = [*_MEAN_COLS, *_MAX_COLS, *_MIN_COLS, "range_gen_mwh", "cv_gen", "cv_demand", "cv_gap"]
_CLASSED = [
    "commercial_customers",
    "commercial_mwh",
    "commercial_revenue",
    "avg_commercial_price_per_mwh",
    "avg_mwh_per_commercial_customer",
    "industrial_customers",
    "industrial_mwh",
    "industrial_revenue",
    "avg_industrial_price_per_mwh",
    "avg_mwh_per_industrial_customer",
    "ci_customers",
    "ci_mwh",
    "ci_revenue",
    "avg_ci_price_per_mwh",
    "avg_mwh_per_ci_customer",
]
_TREND = [
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
_PCTS = [
    "dominant_fuel_pct",
    "early_variable_re_pct",
    "late_variable_re_pct",
    "variable_re_growth_pct",
    "early_total_re_pct",
    "late_total_re_pct",
    "total_re_growth_pct",
    "early_fossil_pct",
    "late_fossil_pct",
    "fossil_change_pct",
]
_STATS = ["avg_cost_per_mwh", "min_cost_per_mwh", "max_cost_per_mwh", "std_dev_cost_per_mwh", "cost_range_per_mwh", "cv_cost", "avg_null_pct"]
_PRICES = ["avg_cost_per_mmbtu", "min_cost_per_mmbtu", "max_cost_per_mmbtu", "total_fuel_consumed_mmbtu", "total_fuel_cost"]
_LABELS = ["dominant_fuel_type", "transition_status", "concentration_class"]
_BASE_NUMBERS = [
    "cv_gen",
    "cv_demand",
    "avg_ramp_rate_mwh",
    "gas_cv_cost",
    "gas_avg_cost_per_mwh",
    "oil_avg_cost_per_mwh",
    "oil_coal_spread",
    "gas_coal_spread",
    "hhi_concentration",
    "fossil_share",
    "variable_re_growth_pct",
    "late_fossil_pct",
    "late_variable_re_pct",
]
_RES = [
    "residential_price_score",
    "residential_market_size_score",
    "residential_consumption_score",
    "reliability_score",
    "market_structure_score",
    "residential_access_score",
    "wholesale_complexity_score",
    "residential_composite_score",
]
_CI = [
    "ci_price_score",
    "ci_market_size_score",
    "ci_consumption_score",
    "reliability_score",
    "ci_access_score",
    "dc_opportunity_score",
    "ci_composite_score",
]
_DC_FLAGS = [
    "dc_grid_constraint_flag",
    "dc_fossil_delay_flag",
    "dc_onsite_gen_flag",
    "dc_capacity_score",
    "dc_facilities_score",
    "dc_power_constraint_score",
]

_TABLES: dict[str, tuple[str, list[str], list[str], list[str]]] = {
    "module_a_base": (
        "a_base",
        [*_KEYS, "period"],
        [],
        ["monthly_gen_mwh"],
    ),
    "module_a_monthly_metrics": (
        "a_month",
        _KEYS,
        [],
        [
            "total_gen_mwh",
            "avg_monthly_gen_mwh",
            "max_monthly_gen_mwh",
            "min_monthly_gen_mwh",
            "std_dev_gen_mwh",
            "range_gen_mwh",
            "coefficient_of_variation",
            *_SHARES,
            "avg_capacity_factor",
        ],
    ),
    "ba_state_mapping": (
        "ba_map",
        ["balancing_authority_code_eia", "state"],
        [],
        [],
    ),
    "module_a_ramp_rates": (
        "ramp_g",
        ["balancing_authority_code_eia"],
        [],
        ["avg_ramp_rate_mwh", "max_ramp_rate_mwh", "std_dev_ramp_rate_mwh"],
    ),
    "module_a_additional_ramps": (
        "ramp_dx",
        ["balancing_authority_code_eia"],
        [],
        [
            "avg_demand_ramp_mwh",
            "max_demand_ramp_mwh",
            "std_dev_demand_ramp_mwh",
            "avg_interchange_ramp_mwh",
            "max_interchange_ramp_mwh",
            "std_dev_interchange_ramp_mwh",
        ],
    ),
    "module_a_hourly_final": (
        "a_hour",
        ["balancing_authority_code_eia"],
        ["null_count"],
        [*_HOUR, "cv_interchange"],
    ),
    "module_a2_state_hourly_metrics": (
        "a2",
        ["state"],
        ["min_null_count"],
        _HOUR,
    ),
    "module_b_base": (
        "b_base",
        [*_KEYS, "period"],
        ["record_count", "null_cost_count"],
        _PRICES,
    ),
    "module_b_cost_per_mwh": (
        "b_cost",
        [*_KEYS, "period"],
        ["record_count", "null_cost_count"],
        [*_PRICES, "null_pct", "benchmark_heat_rate", "est_cost_per_mwh"],
    ),
    "module_b_metrics": (
        "b_stat",
        _KEYS,
        ["month_count", "high_null_flag"],
        _STATS,
    ),
    "module_b_cost_spread": (
        "b_spread",
        ["state"],
        ["any_high_null_flag"],
        ["gas_avg_cost_per_mwh", "coal_avg_cost_per_mwh", "oil_avg_cost_per_mwh", "gas_coal_spread", "gas_oil_spread", "oil_coal_spread"],
    ),
    "module_c_concentration": (
        "c_conc",
        ["state", "dominant_fuel_type"],
        ["fuel_type_count"],
        ["hhi_concentration", "dominant_fuel_share"],
    ),
    "module_c_renewable_trend": (
        "c_trend",
        ["state"],
        [],
        _TREND,
    ),
    "module_c_summary": (
        "c_sum",
        ["state", *_LABELS],
        ["fuel_type_count"],
        ["hhi_concentration", *_PCTS],
    ),
    "module_c_fuel_share": (
        "c_fuel",
        _KEYS,
        [],
        ["total_fuel_gen_mwh", "fuel_share"],
    ),
    "module_d_industrial_load": (
        "d_ind",
        ["state"],
        [],
        ["industrial_mwh", "total_mwh", "industrial_pct"],
    ),
    "module_d_storage_deployment": (
        "d_sto",
        ["state"],
        [
            "storage_units",
            "units_arbitrage",
            "units_freq_reg",
            "units_peak_shaving",
            "units_backup_power",
            "units_spinning_reserve",
            "total_use_case_activations",
        ],
        ["total_discharge_mw"],
    ),
    "module_d_reliability": (
        "d_rel",
        ["state"],
        ["years_covered"],
        ["saidi_weighted_avg", "total_customers"],
    ),
    "module_d_regulatory_receptiveness": (
        "d_reg",
        ["state"],
        [],
        ["ee_savings_mwh", "ee_peak_reduction_mw", "dr_peak_reduction_mw", "dr_savings_mwh"],
    ),
    "module_ref_cooperative_density": (
        "coops",
        ["state"],
        [],
        ["cooperative_customer_pct", "cooperative_mwh_pct", "saidi_weighted_avg"],
    ),
    "market_structure_ref": (
        "(SELECT state, iso AS iso_rto, kind AS market_structure, choice AS ci_choice_pct, residential_access_score, wholesale_complexity_score FROM access)",
        ["state", "iso_rto", "market_structure"],
        ["residential_access_score", "wholesale_complexity_score"],
        ["ci_choice_pct"],
    ),
    "integration_base": (
        "i_base",
        ["state", *_LABELS, "market_structure", "iso_rto"],
        ["gas_high_null_flag", "industrial_load_score"],
        [
            "cv_gen",
            "cv_demand",
            "avg_ramp_rate_mwh",
            "max_ramp_rate_mwh",
            "avg_demand_ramp_mwh",
            "max_demand_ramp_mwh",
            "avg_interchange_mwh",
            "max_deficit_mwh",
            "fossil_share",
            "renewable_share",
            "variable_renewable_share",
            "gas_avg_cost_per_mwh",
            "gas_cv_cost",
            "oil_avg_cost_per_mwh",
            "oil_cv_cost",
            "gas_coal_spread",
            "oil_coal_spread",
            "hhi_concentration",
            "dominant_fuel_pct",
            "variable_re_growth_pct",
            "late_fossil_pct",
            "late_variable_re_pct",
            "incentive_score",
        ],
    ),
    "integration_scores": (
        "i_score",
        ["state", *_LABELS],
        ["gas_high_null_flag"],
        [*_BASE_NUMBERS, *_GRID],
    ),
    "module_e_residential_market": (
        "e_mkt",
        ["state"],
        [],
        ["residential_customers", "residential_mwh", "residential_revenue", "avg_retail_price_per_mwh", "avg_mwh_per_customer"],
    ),
    "module_e_residential_score": (
        "e_score",
        ["state"],
        [],
        ["residential_customers", "avg_retail_price_per_mwh", "avg_mwh_per_customer", "residential_mwh", *_RES],
    ),
    "module_f_dc_score": (
        "f_dc",
        ["state", "major_hubs", "major_operators", "dc_growth_flag"],
        ["dc_facilities", *_DC_FLAGS],
        ["dc_twh_per_year", "dc_inventory_mw", "dc_announced_investment_usd_b", "dc_composite_score"],
    ),
    "module_f_ci_market": (
        "f_mkt",
        ["state"],
        [],
        _CLASSED,
    ),
    "module_f_ci_score": (
        "f_score",
        ["state"],
        [],
        ["ci_customers", "avg_ci_price_per_mwh", "avg_mwh_per_ci_customer", "commercial_customers", "industrial_customers", *_CI],
    ),
    "integration_final_grid": (
        "final_g",
        ["state", *_LABELS],
        ["gas_high_null_flag", "opportunity_rank"],
        [*_GRID, "composite_score"],
    ),
    "integration_final_residential": (
        "final_r",
        ["state", "business_model"],
        ["opportunity_rank"],
        ["residential_customers", "avg_retail_price_per_mwh", "avg_mwh_per_customer", *_RES],
    ),
    "integration_final_ci": (
        "final_c",
        ["state", "business_model", "dc_growth_flag"],
        ["opportunity_rank"],
        ["ci_customers", "commercial_customers", "industrial_customers", "avg_ci_price_per_mwh", "avg_mwh_per_ci_customer", *_CI],
    ),
}


def _digits(col: str) -> int:
    return 3 if "mwh" in col or "cost" in col else 6


def _needed(sql: str) -> list[str]:
    """The listed sub-queries a statement reads, in definition order."""
    wanted: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        new = {n for n in _CTES if n in words and n not in wanted}
        wanted |= new
        todo += [_CTES[n] for n in new]
    return [n for n in _CTES if n in wanted]


def _oracle(source: str, text: list[str], whole: list[str], numbers: list[str]) -> str:
    cols = list(text)
    cols += [f"CAST({c} AS BIGINT) AS {c}" for c in whole]
    cols += [f"round(CAST({c} AS DOUBLE), {_digits(c)}) AS {c}" for c in numbers]
    select = f"SELECT {', '.join(cols)} FROM {source}"
    parts = ",\n".join(f"{n} AS ({_CTES[n]})" for n in _needed(select))
    return f"WITH {parts}\n{select}"


def _tidy(df: DataFrame, whole: list[str], numbers: list[str]) -> DataFrame:
    cols = {c: F.col(c).cast("long") for c in whole}
    cols |= {c: F.round(F.col(c).cast("double"), _digits(c)) for c in numbers}
    return df.withColumns(cols) if cols else df


def _register(name: str, source: str, text: list[str], whole: list[str], numbers: list[str]) -> None:
    @query(name, _oracle(source, text, whole, numbers))
    def run(spark, sf):
        return _tidy(Models(DerivedInputs(spark, sf))[name], whole, numbers)


for _name, _spec in _TABLES.items():
    _register(_name, *_spec)

# --- territories -------------------------------------------------------------------

_LANDS = f"""lands AS (SELECT n_nationkey, upper('Cooperative of ' || n_name) AS name, 'Cooperative of ' || n_name AS raw_name, {_state('n_nationkey')} AS st,
  n_nationkey * 12 AS x, n_regionkey * 8 AS y FROM nation WHERE n_nationkey % 8 <> 7),
sites AS (SELECT CASE WHEN c_custkey % 17 <> 0 THEN c_custkey - c_custkey % 2 END AS id, c_acctbal / 100 AS lat, c_custkey % 360 AS lon,
  c_custkey * 7 % 1009 * 1000000000 + c_custkey AS place,
  CASE WHEN c_custkey % 9 <> 0 THEN floor(c_acctbal) END AS sqft FROM customer WHERE c_custkey % 19 <> 0),
inside AS (SELECT * FROM sites JOIN lands ON lon > x AND lon < x + 25 AND lat > y AND lat < y + 40),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY place, n_nationkey) AS rn FROM inside) WHERE rn = 1),
lots AS (SELECT raw_name, name, st, count(id) AS n, CAST(coalesce(sum(sqft), 0) AS BIGINT) AS area FROM firsts GROUP BY ALL),
firms AS (SELECT s_suppkey AS position, s_suppkey - s_suppkey % 2 AS id, n_name || ' cooperative' || CASE WHEN s_suppkey % 3 = 0 THEN ' inc' ELSE '' END AS firm,
  {_state('n_nationkey')} AS st FROM supplier JOIN nation ON s_nationkey = n_nationkey),
names AS (SELECT DISTINCT name, {sorted_tokens_sql('name')} AS a FROM lots),
picks AS (SELECT upper(firm) AS pick, {sorted_tokens_sql('upper(firm)')} AS b, min(position) AS position FROM firms GROUP BY ALL),
scored AS (SELECT name, pick, position, 200.0 * ({lcs_sql('a', 'b')}) / (length(a) + length(b)) AS score FROM names, picks),
best AS (SELECT name, pick, score FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, position) AS rn FROM scored WHERE score >= 60) WHERE rn = 1),
matched AS (SELECT lots.*, pick, score FROM lots LEFT JOIN best USING (name)),
attached AS (SELECT firms.*, coalesce(n, 0) AS n, coalesce(area, 0) AS area FROM firms LEFT JOIN matched ON upper(firm) = pick)"""


def _territory(spark, sf, name):
    return facilities_in_territory(*facility_inputs(spark, sf))[name]


@query(
    "territory_matches",
    f"WITH {_LANDS} SELECT raw_name AS NAME, st AS STATE, n AS dc_facility_count, area AS dc_sqft_in_territory, pick AS match, round(CAST(score AS DOUBLE), 6) AS score FROM matched",
)
def territory_matches(spark, sf):
    return _territory(spark, sf, "territory_matches").withColumn("score", F.round("score", 6))


@query(
    "dc_in_coop_territory",
    f"WITH {_LANDS} SELECT id AS utility_id_eia, firm AS utility_name_eia, st AS state, n AS dc_facility_count, area AS dc_sqft_in_territory FROM attached",
)
def dc_in_coop_territory(spark, sf):
    return _territory(spark, sf, "dc_in_coop_territory")


@query(
    "dc_in_coop_territory_deduped",
    f"""WITH {_LANDS} SELECT id AS utility_id_eia, arg_min(firm, position) AS utility_name_eia, arg_min(st, position) AS state,
CAST(sum(n) AS BIGINT) AS dc_facility_count, CAST(sum(area) AS BIGINT) AS dc_sqft_in_territory FROM attached GROUP BY id""",
)
def dc_in_coop_territory_deduped(spark, sf):
    return _territory(spark, sf, "dc_in_coop_territory_deduped")


@query(
    "territory_report",
    f"""WITH {_LANDS},
outside AS (SELECT count(*) AS n FROM sites s WHERE NOT EXISTS (SELECT 1 FROM lands WHERE lon > x AND lon < x + 25 AND lat > y AND lat < y + 40))
SELECT 'inside_rows' AS metric, count(*) AS value FROM inside UNION ALL SELECT 'inside_facilities', count(*) FROM firsts
UNION ALL SELECT 'outside_rows', n FROM outside UNION ALL SELECT 'territories', count(*) FROM lots
UNION ALL SELECT 'unmatched_territories', count(*) FILTER (pick IS NULL) FROM matched""",
)
def territory_report(spark, sf):
    features, atlas, utilities = facility_inputs(spark, sf)
    matched = facilities_in_territory(features, atlas, utilities)["territory_matches"]
    return run_report(features, atlas, matched)
