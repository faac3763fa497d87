"""States after overlapping batches equal what is computed from the whole fact."""

from __future__ import annotations

import pytest
from test_etl_fixtures import LOCATIONS, ORDERS, RESTAURANTS, USERS
from test_streaming import HEADER, LINES

from thalimart.plans import business, states
from thalimart.plans.extended import EXTENDED
from thalimart.plans.warehouse import build_warehouse, complete_folders, open_warehouse, warehouse_for
from thalimart.sources.staging import ORDERS_CSV, read_csv_staging, read_csv_table
from thalimart.streaming.incremental import merge_batch

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(str, df.collect()))


def _equal(spark, root):
    wh = open_warehouse(spark, root)
    assert _rows(states.monthly_revenue(spark, root)) == _rows(business.monthly_revenue(wh))
    assert _rows(states.loyalty(spark, root)) == _rows(business.loyalty(wh))
    assert _rows(states.acquisition(spark, root)) == _rows(business.acquisition(wh))


@pytest.fixture()
def grown(spark, tmp_path):
    """A warehouse of the first order lines, and a function that merges more."""
    for name, text in (("users", USERS), ("restaurants", RESTAURANTS), ("locations", LOCATIONS)):
        (tmp_path / f"{name}.csv").write_text(text)

    def orders(part, lines):
        path = tmp_path / f"{part}.csv"
        path.write_text("\n".join([HEADER, *lines]) + "\n")
        return str(path)

    root = str(tmp_path / "wh")
    build_warehouse(spark, read_csv_staging(spark, str(tmp_path / "users.csv"), str(tmp_path / "restaurants.csv"), orders("first", LINES[:6]),
                                            str(tmp_path / "locations.csv")), root)
    return root, lambda part, lines: merge_batch(spark, root, read_csv_table(spark, orders(part, lines), ORDERS_CSV))


def test_three_overlapping_batches(spark, grown):
    root, merge = grown
    assert not states.kept(spark, root)
    states.update(spark, root, open_warehouse(spark, root).orders)
    for part, lines in (("a", LINES[3:10]), ("b", LINES[8:]), ("c", LINES)):  # the last adds nothing
        merge(part, lines)
        _equal(spark, root)
    assert ORDERS.strip()
    pieces = len(complete_folders(spark, f"{root}/state/months"))
    merge("d", LINES)
    assert len(complete_folders(spark, f"{root}/state/months")) == pieces


def test_unfinished_piece_is_written_again_and_pieces_are_compacted(spark, grown):
    root, merge = grown
    states.update(spark, root, open_warehouse(spark, root).orders.where("order_key <= 2"))
    merge("a", LINES[3:])
    names = complete_folders(spark, f"{root}/state/customers")
    assert len(names) == 2
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/state/customers/{names[-1]}/_SUCCESS")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)  # as if its job had been stopped
    states.update(spark, root, open_warehouse(spark, root).orders)
    _equal(spark, root)
    for name in ("months", "customers", "visitors"):
        states.compact(spark, root, name)
        assert len(complete_folders(spark, f"{root}/state/{name}")) == 1
    _equal(spark, root)


def test_no_key_is_shuffled_and_no_row_expanded(spark):
    wh = warehouse_for(spark, SF)
    plan = EXTENDED["state_distinct_customers"](wh)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "customer_key" not in plan
    partial = states._states()["visitors"].partial(wh.orders)._jdf.queryExecution().executedPlan().toString()
    exchange = [line for line in partial.splitlines() if "Exchange" in line]
    assert len(exchange) == 1 and "customer_key" not in exchange[0] and "bucket" in exchange[0]
