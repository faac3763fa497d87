"""Every query key against its independent DuckDB statement on the smallest
test tables (the driver repeats this at sf0.01)."""

from __future__ import annotations

import os

import pytest

from compare import compare, duck
from __spark_entry__ import oracle_sql, queries
from thalimart.oracle import SQL
from thalimart.plans.catalog import QUERIES

SF = os.environ.get("THALIMART_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_key_has_an_oracle():
    assert set(QUERIES) == set(SQL) and len(SQL) == 56
    assert set(SQL) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_oracle(spark, con, key):
    r = compare(spark, con, SF, key)
    assert r["ok"], r


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["income_group", "customer_count", "total_orders",
                          "avg_orders_per_customer"]
    assert df.count() > 0
