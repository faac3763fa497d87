"""Hot keys: one customer places a third of the orders, one restaurant takes a
third, one natural key is staged 500 times. Results must equal a plain
Python computation over the same staged rows, and the dedup must be a
partial (map-side) aggregate so the hot key collapses before the shuffle."""

from __future__ import annotations

import os
from collections import defaultdict
from decimal import Decimal

import pytest

from thalimart.operators.dedup import first_per_key
from thalimart.plans import business, customer, etl
from thalimart.plans.warehouse import build_warehouse
from thalimart.sources.staging import (LOCATION_COLS, ORDERS_COLS, RESTAURANT_COLS, USERS_COLS,
                                       Staging)

N_USERS, N_REST, N_ORDERS = 60, 12, 3000


def _staging_rows():
    users = [(u, f"U{u}", f"u{u}@x", 30, "F", 1 + u % 4,
              ["No Income", "Below Rs.10000", "10001 to 25000", "More than 50000"][u % 4],
              ["Graduate", "School", "Ph.D"][u % 3], 0) for u in range(1, N_USERS + 1)]
    rests = [(r, f"R{r}", ["Pune", "Baner,pune", "Delhi"][r % 3], float(r % 5), "A,B", 0)
             for r in range(1, N_REST + 1)]
    locs = [("India", "MH", "Pune", 0), ("India", "DL", "Delhi", 0)]
    orders = []
    for i in range(N_ORDERS):
        user = 1 if i % 3 == 0 else 2 + i % (N_USERS - 1)      # a third from user 1
        rest = 1 if i % 3 == 1 else 2 + i % (N_REST - 1)        # a third at restaurant 1
        day = 1 + i % 28
        orders.append((user, rest, f"2019-0{1 + i % 9}-{day:02d} 10:00:00", 1 + i % 3,
                       float(100 + i % 50), "INR", i))
    hot = (5, 5, "2019-05-05 05:05:05", 2, 55.0, "usd", None)
    orders += [hot[:-1] + (N_ORDERS + k,) for k in range(500)]   # one key, 500 copies
    return users, rests, locs, orders


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    users, rests, locs, orders = _staging_rows()
    st = Staging(
        users=spark.createDataFrame(users, "user_id long, name string, email string, age int, "
                                    "gender string, family_size int, monthly_income string, "
                                    "education string, ingest_seq long").select(*USERS_COLS),
        restaurants=spark.createDataFrame(rests, "id long, name string, city string, "
                                          "rating double, cuisine string, ingest_seq long")
        .select(*RESTAURANT_COLS),
        locations=spark.createDataFrame(locs, "country string, state string, city string, "
                                        "ingest_seq long").select(*LOCATION_COLS),
        orders=spark.createDataFrame(orders, "user_id long, r_id long, order_date string, "
                                     "sales_qty int, sales_amount double, currency string, "
                                     "ingest_seq long").select(*ORDERS_COLS).repartition(6))
    root = os.path.join(str(tmp_path_factory.mktemp("skew")), "w")
    return st, build_warehouse(spark, st, root), orders


def test_hot_key_collapses_map_side(built):
    st, _, _ = built
    plan = first_per_key(etl.staged_fact_rows(st.orders), ["order_nk"], ["ingest_seq"]) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_results_match_brute_force(built):
    _, wh, orders = built
    # brute force: distinct natural keys (all copies of the hot order collapse)
    seen, per_user = set(), defaultdict(lambda: [0, Decimal(0)])
    for u, r, d, q, a, c, _ in orders:
        nk = (u, r, d, c, q, a)
        if nk in seen:
            continue
        seen.add(nk)
        amt = Decimal(str(a)) * (87 if c == "usd" else 1)
        per_user[u][0] += 1
        per_user[u][1] += amt
    assert wh.fact.count() == len(seen) == N_ORDERS + 1

    loyalty = {r.customer_segment: r.customer_count for r in business.loyalty(wh).collect()}
    want = defaultdict(int)
    for n, _ in per_user.values():
        want["One-time" if n == 1 else "Occasional" if n <= 5 else
             "Regular" if n <= 15 else "Frequent"] += 1
    assert loyalty == dict(want)

    spend = {r.income_group: r for r in customer.income_spending(wh).collect()}
    incomes = ["No Income", "Below 10k", "10k-25k", "50k+"]
    totals = defaultdict(Decimal)
    for u, (_, s) in per_user.items():
        totals[incomes[u % 4]] += s
    for g, s in totals.items():
        assert spend[g].total_spending == float(round(s, 2))
