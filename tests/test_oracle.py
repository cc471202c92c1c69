"""Every registered query against its SQL on whole tables."""

from __future__ import annotations

import pytest

from compare import TESTDATA, differences, duck
from statewatt.catalog import ORACLES, QUERIES

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert name in ORACLES
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
