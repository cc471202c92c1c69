"""The queries with SQL against it, on whole tables."""

from __future__ import annotations

import pytest

from compare import TESTDATA, differences, duck
from statewatt.llm.queries import ORACLES, QUERIES

SF = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) is None


def test_a_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name,table", [("op2_simhash_near_dedup", "documents"), ("op6_toxicity", "documents"), ("op7_html_extraction", "pages")])
def test_a_row_for_each_row(spark, name, table):
    found = QUERIES[name](spark, SF)
    key = found.columns[0]
    assert sorted(r[0] for r in found.select(key).collect()) == sorted(r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect())
