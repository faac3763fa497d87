"""Queries that SQL can express, against DuckDB over the same tables."""

import duckdb
import pytest

from thalimart.llm import queries as Q


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
@pytest.mark.parametrize("key", sorted(Q.SQL))
def test_query_equals_sql(spark, key, sf):
    con = duckdb.connect()
    for t in ("pages", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf{sf}/{t}.parquet')")
    found = Q.QUERIES[key](spark, f"/root/testdata/sf{sf}")
    rows = con.execute(Q.SQL[key])
    assert [d[0] for d in rows.description] == found.columns
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, rows.fetchall()))
