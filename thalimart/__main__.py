"""Command line: build the warehouse from staging CSVs, run named queries or SQL.

    python -m thalimart build STAGING_DIR WAREHOUSE_DIR
        STAGING_DIR holds users.csv, restaurants.csv, orders.csv, locations.csv
        (the staging layout, header line first; each may also be a folder).
    python -m thalimart refresh STAGING_DIR WAREHOUSE_DIR
        builds a new version beside the one that readers use, then publishes it.
    python -m thalimart query WAREHOUSE_DIR KEY [--out PATH] [--format parquet|csv]
    python -m thalimart sql WAREHOUSE_DIR "SELECT ... FROM fact_order ..." [--out PATH]
    python -m thalimart list

``--master`` runs without spark-submit (for example ``--master local[4]``); under
spark-submit the cluster's own settings hold. Intermediate tables of a build go
under WAREHOUSE_DIR.

Without ``--out`` the first rows are printed; with it the whole result is
written by the executors (nothing is collected to the driver).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame


def _session(master: str | None):
    from .session import build_session
    return build_session(master=master)


def _emit(df: DataFrame, out: str | None, fmt: str) -> None:
    if out:
        df.write.mode("overwrite").format(fmt).option("header", "true").save(out)
    else:
        df.show(50, truncate=False)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="thalimart")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("build", "refresh"):
        b = sub.add_parser(name)
        b.add_argument("staging_dir")
        b.add_argument("warehouse_dir")
        b.add_argument("--blank-as-empty", action="store_true")
    for name in ("query", "sql"):
        q = sub.add_parser(name)
        q.add_argument("warehouse_dir")
        q.add_argument("text")
        q.add_argument("--out")
        q.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    sub.add_parser("list")
    a = p.parse_args(argv)

    from .plans.catalog import QUERIES
    from .plans.extended import EXTENDED
    known = QUERIES | EXTENDED
    if a.cmd == "list":
        print("\n".join(known))
        return 0
    spark = _session(a.master)
    from .plans.published import open_current, refresh
    from .plans.warehouse import build_warehouse
    if a.cmd in ("build", "refresh"):
        from .sources.staging import read_csv_staging
        d = a.staging_dir.rstrip("/")
        st = read_csv_staging(spark, f"{d}/users.csv", f"{d}/restaurants.csv", f"{d}/orders.csv",
                              f"{d}/locations.csv", blank_as_empty=a.blank_as_empty)
        (build_warehouse if a.cmd == "build" else refresh)(spark, st, a.warehouse_dir.rstrip("/"))
        return 0
    wh = open_current(spark, a.warehouse_dir)
    if a.cmd == "query":
        if a.text not in known:
            print(f"unknown key {a.text!r}; see `python -m thalimart list`", file=sys.stderr)
            return 2
        _emit(known[a.text](wh), a.out, a.format)
    else:
        from .plans.views import register_views
        register_views(spark, wh)
        _emit(spark.sql(a.text), a.out, a.format)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
