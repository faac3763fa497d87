"""Spark-vs-DuckDB comparison used by the tests and by hand:

    python tests/compare.py [sf_dir] [key ...]

Compares row count, column names and an order-insensitive hash of the
values (columns sorted by name, floats normalised to 9 significant digits).
"""

from __future__ import annotations

import hashlib
import math
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(cols: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def compare(spark, con, sf_dir: str, key: str) -> dict:
    from __spark_entry__ import oracle_sql, queries
    sdf = queries()[key](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(oracle_sql()[key])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    out = {"key": key, "rows": (len(s_rows), len(o_rows)),
           "cols_match": sorted(s_cols) == sorted(o_cols),
           "hash_match": digest(s_cols, s_rows) == digest(o_cols, o_rows)}
    out["ok"] = out["cols_match"] and out["hash_match"] and len(s_rows) == len(o_rows)
    if not out["ok"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, o_cols
        out["spark_sample"] = sorted(map(str, s_rows))[:5]
        out["oracle_sample"] = sorted(map(str, o_rows))[:5]
    return out


def main(argv: list[str]) -> int:
    from thalimart.session import build_session
    from __spark_entry__ import oracle_sql
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or list(oracle_sql())
    spark = build_session(master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, con, sf_dir, k)
        except Exception as e:  # report and continue
            r = {"key": k, "ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not r["ok"]
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
