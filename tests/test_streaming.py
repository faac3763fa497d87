"""Streaming incremental load: initial CSV load, then a later batch of order
files through the stream; the fact must equal a full refresh over both
(except for key numbering), and a replayed batch must add nothing."""

from __future__ import annotations

import os

from test_etl_fixtures import LOCATIONS, ORDERS, RESTAURANTS, USERS

from thalimart.plans.warehouse import build_warehouse, open_warehouse
from thalimart.sources.staging import read_csv_staging
from thalimart.streaming.incremental import late_orders, merge_batch, start_incremental_load

HEADER, *LINES = ORDERS.strip().splitlines()
FIRST = LINES[:9]
LATER = LINES[5:]       # overlaps the first batch on purpose


def _write(path, lines):
    with open(path, "w") as fh:
        fh.write("\n".join([HEADER, *lines]) + "\n")


def _facts(wh):
    return sorted((r.order_nk, r.currency, str(r.sales_amount), r.location_key)
                  for r in wh.fact.collect())


def test_stream_matches_full_refresh(spark, tmp_path):
    d = tmp_path
    for name, text in [("users", USERS), ("restaurants", RESTAURANTS), ("locations", LOCATIONS)]:
        (d / f"{name}.csv").write_text(text)
    _write(d / "orders_all.csv", LINES)
    full = build_warehouse(spark, read_csv_staging(
        spark, str(d / "users.csv"), str(d / "restaurants.csv"), str(d / "orders_all.csv"),
        str(d / "locations.csv")), str(d / "full"))

    (d / "first").mkdir()
    _write(d / "first" / "orders.csv", FIRST)
    root = str(d / "inc")
    build_warehouse(spark, read_csv_staging(
        spark, str(d / "users.csv"), str(d / "restaurants.csv"), str(d / "first"),
        str(d / "locations.csv")), root)

    (d / "incoming").mkdir()
    _write(d / "incoming" / "batch1.csv", LATER)
    q = start_incremental_load(spark, str(d / "incoming"), root, str(d / "stream-ckpt"))
    q.awaitTermination(300)
    assert q.exception() is None

    inc = open_warehouse(spark, root)
    assert _facts(inc) == _facts(full)
    keys = [r.order_key for r in inc.fact.collect()]
    assert len(keys) == len(set(keys))
    assert inc.dim_date.count() == full.dim_date.count()

    # replaying the same batch adds nothing (insert-or-ignore)
    merge_batch(spark, root, inc.staging.orders.limit(0).unionByName(
        read_csv_staging(spark, str(d / "users.csv"), str(d / "restaurants.csv"),
                         str(d / "incoming"), str(d / "locations.csv")).orders))
    assert _facts(open_warehouse(spark, root)) == _facts(full)
    assert os.path.isdir(root)


def test_late_dimension_rows_and_locations(spark, tmp_path):
    """Orders that come before their user or restaurant wait and are loaded with
    it; locations that arrive later are patched in; a full load gives the same."""
    d = tmp_path
    heads = {n: t.strip().splitlines() for n, t in (("users", USERS), ("restaurants", RESTAURANTS), ("locations", LOCATIONS), ("orders", ORDERS))}
    extra = ["99,77,2024-05-05 10:00:00,3,55,INR"]

    def staging(name, keep):
        folder = d / name
        folder.mkdir()
        for n, (head, *lines) in heads.items():
            (folder / f"{n}.csv").write_text("\n".join([head, *keep(n, lines)]) + "\n")
        return read_csv_staging(spark, *(str(folder / f"{n}.csv") for n in ("users", "restaurants", "orders", "locations")))

    new = {"users": ["99,New,n@x,20,F,1,No Income,Graduate"], "restaurants": ["77,R9,Old Pune,4.0,Z"], "orders": extra}
    full = build_warehouse(spark, staging("all", lambda n, x: x + new.get(n, [])), str(d / "full"))
    root = str(d / "inc")
    build_warehouse(spark, staging("one", lambda n, x: {"locations": x[1:3], "orders": []}.get(n, x)), root)

    def facts(wh):
        cities = wh.orders.select("order_nk", "currency", "sales_amount", "loc_city")
        return sorted(str(tuple(r)) for r in cities.collect())
    second = staging("two", lambda n, x: x + extra if n == "orders" else [])
    merge_batch(spark, root, second.orders)
    assert {r.r_id for r in late_orders(spark, root).collect()} >= {"77", "99"}
    before = facts(open_warehouse(spark, root))
    third = staging("three", lambda n, x: new.get(n, []) if n != "orders" else [])
    places = staging("four", lambda n, x: x if n == "locations" else [])
    merge_batch(spark, root, third.orders, third.users, third.restaurants, places.locations)
    after = open_warehouse(spark, root)

    assert len(before) < len(facts(after))
    assert [x.split(",")[0] for x in facts(after)] == [x.split(",")[0] for x in facts(full)]
    assert all(r.loc_city for r in after.orders.where("restaurant_city LIKE '%une%' OR restaurant_city LIKE '%UNE%'").collect())
    keys = [r.customer_key for r in after.dim_customer.collect()]
    assert len(keys) == len(set(keys)) == full.dim_customer.count()
    assert not any(r.r_id == "77" for r in late_orders(spark, root).collect())
    assert len({r.order_key for r in after.fact.collect()}) == after.fact.count()
