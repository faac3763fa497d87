"""Warehouse invariants and arithmetic checks of published results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from thalimart.functions.numeric import money_round, safe_div
from thalimart.plans.catalog import QUERIES
from thalimart.plans.warehouse import warehouse_for

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse_for(spark, SF)


def test_zero_orphans_and_unique_keys(wh):
    assert all(r.rows == 0 for r in QUERIES["qa_fk_orphans"](wh).collect())
    assert all(r.duplicate_keys == 0 for r in QUERIES["dq_unique_keys"](wh).collect())


def test_dense_surrogate_keys(wh):
    for df, key in [(wh.dim_customer, "customer_key"), (wh.dim_restaurant, "restaurant_key"),
                    (wh.dim_location, "location_key")]:
        r = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(key).alias("n")).first()
        assert (r.lo, r.hi) == (1, r.n)
    # order keys: distinct, numbered before the delete (gaps only where rows were deleted)
    r = wh.fact.agg(F.min("order_key").alias("lo"), F.countDistinct("order_key").alias("d"),
                    F.count("order_key").alias("n")).first()
    assert r.lo >= 1 and r.d == r.n


@pytest.mark.parametrize("key,group", [("rq1_1_income_distribution", None),
                                       ("rq1_4_cuisine_by_income", "income_group"),
                                       ("rq1_6_cuisine_by_education", "education_group"),
                                       ("rq1_7_weekend_by_education", "education_group"),
                                       ("rq3_5_family_revenue_share", None),
                                       ("bi4_seasonality", None)])
def test_shares_sum_to_100(wh, key, group):
    col = "revenue_percentage" if key in ("rq3_5_family_revenue_share", "bi4_seasonality") \
        else "percentage"
    rows = QUERIES[key](wh).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r[group] if group else None, []).append(r[col])
    for g, vals in groups.items():
        total = sum(vals)
        if key == "rq1_4_cuisine_by_income":
            assert total <= 100.0 + 0.01 * len(vals)    # top five of all cuisines
        else:
            assert abs(total - 100.0) <= 0.01 * len(vals), (g, total)


def test_published_ratios_reproduce(spark):
    # The published per-income-group results of RQ1.2 / RQ1.3
    # (customers, orders, orders per customer, spend, spend per customer).
    published = [
        ("None", 48204, 70833, 1.47, 463419766.0, 9613.72),
        ("Below 10k", 6442, 9492, 1.47, 66436998.0, 10313.1),
        ("10k-25k", 11599, 16910, 1.46, 105542983.0, 9099.32),
        ("25k-50k", 17779, 26141, 1.47, 170706789.0, 9601.6),
        ("50k+", 15976, 23687, 1.48, 158217241.0, 9903.43),
    ]
    df = spark.createDataFrame(published, "g string, c long, o long, apc double, s double, spc double")
    got = df.select("apc", "spc",
                    money_round(safe_div(F.col("o"), F.col("c")), 2).alias("apc2"),
                    money_round(safe_div(F.col("s"), F.col("c")), 2).alias("spc2")).collect()
    for r in got:
        assert (r.apc, r.spc) == (r.apc2, r.spc2)
    assert sum(p[1] for p in published) == 100000 and sum(p[2] for p in published) == 147063


def test_expected_counts_at_sf001(wh):
    """Counts taken from the independent DuckDB relation (thalimart.oracle) over
    the raw tables at sf0.01."""
    f = wh.orders
    staged = wh.staging.orders.count()
    assert (staged, f.count()) == (60833, 57400) and f.count() > 0.9 * staged
    assert f.where("location_key IS NULL").count() == 3480
    assert f.where("is_weekend = 1").count() == 15913
    assert f.where("is_holiday = 1").count() == 842
    assert f.where(F.col("sales_amount") == -87).count() == 324
    per_year = {r.year: r["count"] for r in f.groupBy("year").count().collect()}
    assert per_year == {2014: 8736, 2015: 8610, 2016: 8666, 2017: 8599, 2018: 8857, 2019: 9036, 2020: 4896}
    fest = {r.year: r.n for r in f.where("month IN (10, 11) AND year IN (2017, 2018, 2019)")
            .groupBy("year").agg(F.countDistinct("restaurant_key").alias("n")).collect()}
    assert fest == {2017: 100, 2018: 100, 2019: 100}
    loyalty = {r.customer_segment: r.customer_count for r in QUERIES["bi2_loyalty"](wh).collect()}
    assert loyalty == {"One-time": 74, "Occasional": 614, "Regular": 252, "Frequent": 1384}
    ordering = f.select("customer_key").distinct()
    assert wh.dim_customer.join(ordering, "customer_key", "left_anti").count() == 489
