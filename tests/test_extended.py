"""The extended keys against their DuckDB statements, and what their plans hold."""

from __future__ import annotations

import os

import pytest

from compare import compare, duck
from __spark_entry__ import oracle_sql, queries
from thalimart.oracle_extended import SQL_EXTENDED
from thalimart.plans.extended import EXTENDED
from thalimart.plans.warehouse import warehouse_for

SF = os.environ.get("THALIMART_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_key_is_registered():
    assert set(EXTENDED) == set(SQL_EXTENDED)
    assert set(EXTENDED) <= set(queries()) and set(SQL_EXTENDED) <= set(oracle_sql())


@pytest.mark.parametrize("key", sorted(SQL_EXTENDED))
def test_matches_oracle(spark, con, key):
    r = compare(spark, con, SF, key)
    assert r["ok"], r


@pytest.mark.parametrize("key", sorted(EXTENDED))
def test_no_python_and_no_pairwise_joins(spark, key):
    plan = EXTENDED[key](warehouse_for(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
