"""Every staged order gets one reason, in one pass; what waits is loaded later."""

from __future__ import annotations

import pytest
from test_etl_fixtures import LOCATIONS, RESTAURANTS, USERS

from thalimart.plans import etl, rules
from thalimart.plans.warehouse import build_warehouse, warehouse_for
from thalimart.sources.staging import ORDERS_COLS, read_csv_staging

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse_for(spark, SF)


def test_accepted_orders_are_the_facts(spark, wh, tmp_path):
    path = str(tmp_path / "load")
    counts = rules.checked_load(wh.staging.order_cells, wh, path)
    assert counts[rules.ACCEPTED] == wh.fact.count() == rules.accepted(spark, path).count()
    loaded = etl.load_fact(wh.staging.order_cells, wh.dim_customer, wh.dim_restaurant).where("amount not in (0.0, -1.0)")
    got = rules.accepted(spark, path).select(*loaded.columns)
    assert got.exceptAll(loaded).isEmpty() and loaded.exceptAll(got).isEmpty()
    assert sum(counts.values()) == wh.staging.orders.count()
    per_reason = {r[0]: r[1] for r in rules.quarantine(spark, path).groupBy("reason").count().collect()}
    assert per_reason == {r: n for r, n in counts.items() if n and r in rules.REASONS}


def test_first_reason_counts_and_raw_cells_stay(spark, tmp_path):
    files = {"users": USERS, "restaurants": RESTAURANTS, "locations": LOCATIONS, "orders": "user_id,r_id,order_date,sales_qty,sales_amount,currency\n"}
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    staging = read_csv_staging(spark, *(str(tmp_path / f"{n}.csv") for n in ("users", "restaurants", "orders", "locations")))
    wh = build_warehouse(spark, staging, str(tmp_path / "wh"))
    user, kitchen = wh.dim_customer.first().user_id_nat, wh.dim_restaurant.first().restaurant_id_nat
    day = "2018-05-05 10:00:00"
    rows = [(user, kitchen, "x", None, None, "INR"), (user, kitchen, None, "1", "5", "INR"), (user, kitchen, day, None, "5", "INR"), (user, kitchen, day, "1", None, " USD "),
            (user, kitchen, day, "1", "1e30", "INR"), ("nobody", "nowhere", day, "1", "5", "INR"), (None, kitchen, day, "1", "5", "INR"), (user, "nowhere", day, "1", "5", "INR"),
            (user, kitchen, day, "1", "-1", "INR"), (user, kitchen, day, "1", "-1", "usd"), (user, kitchen, day, "2", "7", None), (user, kitchen, day, "2", "7.0", None)]
    orders = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ", ".join(f"{c} string" for c in ORDERS_COLS[:-1]) + ", ingest_seq long").repartition(3)
    path = str(tmp_path / "load")
    counts = rules.checked_load(orders, wh, path)
    assert counts == {"bad_date": 2, "no_quantity": 1, "no_amount": 1, "amount_too_large": 1, "unknown_user": 2, "unknown_restaurant": 1,
                      "deleted_amount": 1, "accepted": 2, "duplicate": 1}
    held = sorted(map(str, (tuple(r) for r in rules.quarantine(spark, path).select("reason", *ORDERS_COLS[:-1]).collect())))
    reasons = ["bad_date"] * 2 + ["no_quantity", "no_amount", "amount_too_large", "unknown_user", "unknown_user", "unknown_restaurant", "deleted_amount"]
    assert held == sorted(map(str, ((k, *r) for k, r in zip(reasons, rows))))
    assert rules.waiting(rules.quarantine(spark, path)).count() == 3
    assert sorted(float(r.amount) for r in rules.accepted(spark, path).collect()) == [-87.0, 7.0]


def test_empty_batch(spark, wh, tmp_path):
    path = str(tmp_path / "load")
    assert set(rules.checked_load(wh.staging.order_cells.limit(0), wh, path).values()) == {0}
    assert rules.quarantine(spark, path).count() == 0 == rules.accepted(spark, path).count()


def test_one_scan_of_the_staging(spark, wh):
    plan = rules.decided(wh.staging.order_cells, wh.dim_customer, wh.dim_restaurant)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("stg_orders") <= 2  # one scan, named once in the line and once in its paths
    scans = [line for line in plan.splitlines() if "FileScan" in line and "p_amount_text" in line]
    assert len(scans) == 1


def test_a_load_keeps_what_its_readers_need(spark, wh, tmp_path):
    path = str(tmp_path / "load")
    rules.checked_load(wh.staging.order_cells, wh, path)
    rows = spark.read.schema(rules._SCHEMA).parquet(path)
    assert rows.where("reason = 'accepted' AND (raw_order_date IS NOT NULL OR order_nk IS NULL)").isEmpty()
    assert rows.where("reason <> 'accepted' AND (raw_r_id IS NULL OR order_nk IS NOT NULL)").isEmpty()
    plan = rules.decided(wh.staging.order_cells, wh.dim_customer, wh.dim_restaurant)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("p_tail" in line for line in dealt)
