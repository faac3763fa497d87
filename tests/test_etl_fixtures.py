"""Hand-made staging CSVs (FIXTURES.md micro fixtures) through the CSV
readers, the full ETL and the analyses; expected rows are written out from
the source script's rules."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest

from thalimart.plans import business, customer, restaurant
from thalimart.plans.warehouse import build_warehouse
from thalimart.sources.staging import read_csv_staging

USERS = """user_id,name,email,age,gender,Family size,Monthly Income,Educational qualifications
1,A,a@x,30,F,1,No Income,Graduate
2,B,b@x,31,M,2,Below Rs.10000,PH.D
3,C,c@x,,F,3,10001 to 25000,Ph.D
4,D,d@x,40,M,0,25001 to 50000,SCHOOL
5,E,e@x,50,F,,More than 50000,
6,F,f@x,22,M,4,something,Uneducated
7,G,g@x,33,F,2,No Income,Graduate
7,H,h@x,34,M,2,No Income,Graduate
8,I,i@x,45,M,1,,Graduate
9.0,J,j@x,45,M,1,,Graduate
"""

RESTAURANTS = """id,name,city,rating,cuisine
10,R1,"Baner,PUNE",4.5,"A,,B,"
11,R2,Pune,4.0,"A,A"
12,R3,Nowhere,--,
13,R4,mumbai central,3.0," Biryani , Indian"
14,R1,"Baner,PUNE",4.5,"A,,B,"
15,R5,Pune,,X
"""

LOCATIONS = """Country,State,City
India,Maharashtra,Pune
India,,Mumbai
India,MH,Mumbai
India,Maharashtra,"Baner,PUNE"
"""

ORDERS = """user_id,r_id,order_date,sales_qty,sales_amount,currency
1,10,2024-01-07 10:00:00,2,-1,USD
1,10,2024-01-06 10:00:00,1,-1,INR
2,11,2024-01-08 10:00:00,1,0,usd
2,11,2024-12-25 12:00:00,1,-5,INR
3,10,2024-12-31 12:00:00,1,10, usd
3,10,2024-12-26 12:00:00,1,10,
4,13,2024-02-14 09:00:00,1,10,EUR
4,13,2024-02-14 09:00:00,1,10,EUR
4,13,2024-02-14 09:00:00,1,10, EUR
99,10,2024-03-01 00:00:00,1,10,INR
5,99,2024-03-01 00:00:00,1,10,INR
5,10,bad,1,10,INR
9,10,2024-03-01 00:00:00,1,10,INR
5,10,2024-03-02 00:00:00,,10,INR
5,10,2024-03-03 00:00:00,1,,INR
6,12,2017-11-05 00:00:00,1,100,INR
6,12,2018-02-05 00:00:00,1,100,INR
7,10,2018-10-10 00:00:00,1,500,INR
7,14,2018-10-11 00:00:00,1,500,INR
"""


@pytest.fixture(scope="module")
def wh(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("staging")
    for name, text in [("users", USERS), ("restaurants", RESTAURANTS),
                       ("locations", LOCATIONS), ("orders", ORDERS)]:
        (d / f"{name}.csv").write_text(text)
    staging = read_csv_staging(spark, str(d / "users.csv"), str(d / "restaurants.csv"),
                               str(d / "orders.csv"), str(d / "locations.csv"))
    root = str(tmp_path_factory.mktemp("wh"))
    return build_warehouse(spark, staging, os.path.join(root, "w"))


def _fact(wh):
    rows = wh.fact.join(wh.dim_customer.select("customer_key", "user_id_nat"), "customer_key") \
        .join(wh.dim_restaurant.select("restaurant_key", "restaurant_id_nat"), "restaurant_key") \
        .collect()
    return {(r.user_id_nat, r.restaurant_id_nat, r.date_key): r for r in rows}


def test_customers(wh):
    c = {r.user_id_nat: r for r in wh.dim_customer.collect()}
    assert set(c) == {"1", "2", "3", "4", "5", "6", "7", "8", "9.0"}
    assert c["7"].name == "G"                                   # M10 first row wins
    assert (c["1"].income_group, c["1"].income_group_order) == ("No Income", 9)   # M1
    assert (c["8"].income_group, c["8"].income_group_order) == ("Unknown", 9)     # M2
    assert (c["2"].education_group, c["3"].education_group, c["4"].education_group,
            c["5"].education_group) == ("Unknown", "Doctoral", "Basic Education", "Unknown")
    assert c["3"].age is None and c["5"].family_size is None
    assert sorted(r.customer_key for r in c.values()) == list(range(1, 10))


def test_locations_and_restaurants(wh):
    locs = [(r.location_nk, r.state) for r in wh.dim_location.orderBy("location_key").collect()]
    # M11: (India, NULL, Mumbai) and (India, '', Mumbai) would collide; here blank reads as NULL
    assert locs == [("India||Mumbai", None), ("India|MH|Mumbai", "MH"),
                    ("India|Maharashtra|Baner,PUNE", "Maharashtra"),
                    ("India|Maharashtra|Pune", "Maharashtra")]
    r = {x.restaurant_id_nat: x for x in wh.dim_restaurant.collect()}
    assert r["12"].rating == 0.0 and r["15"].rating is None    # M26 lenient '--' -> 0.0
    assert r["12"].cuisine is None


def test_fact_rules(wh):
    f = _fact(wh)
    got = {k: (float(v.sales_amount), v.currency) for k, v in f.items()}
    assert got[("1", "10", 20240107)] == (-87.0, "INR")         # M4 USD -1 survives as -87
    assert ("1", "10", 20240106) not in got                     # M4 INR -1 deleted
    assert ("2", "11", 20240108) not in got                     # M4 USD 0 deleted
    assert got[("2", "11", 20241225)] == (-5.0, "INR")          # M4 other negatives stay
    assert got[("3", "10", 20241231)] == (870.0, "INR")         # M5
    assert got[("3", "10", 20241226)] == (10.0, None)           # M5 NULL currency untouched
    assert got[("4", "13", 20240214)] == (10.0, "EUR")
    assert sum(1 for k in f if k[:2] == ("4", "13")) == 1       # M6, M7 collapse
    assert not any(k[0] in ("99", "9", "5") for k in f)         # M8, M9, M27
    assert len(f) == 9
    assert f[("1", "10", 20240107)].sales_amount == Decimal("-87.0000")


def test_dates_and_locations_on_fact(wh):
    d = {r.date_key: r for r in wh.dim_date.collect()}
    assert (d[20240107].dow, d[20240107].is_weekend) == (1, 1)   # M13 Sunday
    assert (d[20240106].dow, d[20240106].is_weekend) == (7, 1)   # Saturday (dropped order, date kept)
    assert (d[20240108].dow, d[20240108].is_weekend) == (2, 0)
    assert d[20240107].month_name == "Jan" and d[20241225].quarter == 4
    o = {r.order_nk.split("|")[1]: r.location_key for r in wh.fact.collect()}
    loc = {r.location_key: r.city for r in wh.dim_location.collect()}
    assert loc[o["10"]] == "Baner,PUNE"       # min key among 'Baner,PUNE' and 'Pune'
    assert loc[o["11"]] == "Pune"             # M12 'Pune' does not contain 'Baner,PUNE'
    assert o["12"] is None                    # 'Nowhere' matches nothing
    assert loc[o["13"]] == "Mumbai"           # case-insensitive substring


def test_analyses_on_fixture(wh):
    # M21: first order 2017-11 and 2018-02 -> (2017, 2)
    bi5 = {(r.first_order_year, r.first_order_month): r.new_customers
           for r in business.acquisition(wh).collect()}
    assert bi5[(2017, 2)] == 1
    # M22: customers without orders count in RQ1.2 but not in BI2
    rq12 = {r.income_group: r for r in customer.income_frequency(wh).collect()}
    # Unknown income: users 6 ('something'), 8 and 9.0 (blank); 8 and 9.0 have no order
    assert (rq12["Unknown"].customer_count, rq12["Unknown"].total_orders) == (3, 2)
    assert sum(r.customer_count for r in rq12.values()) == 9
    bi2 = business.loyalty(wh).collect()
    assert sum(r.customer_count for r in bi2) == 6
    # M18: restaurants 10 and 14 tie on 2018 festival sales -> both kept
    fest = [(r.year, r.restaurant_key) for r in restaurant.festival_top(wh).collect()]
    assert len([y for y, _ in fest if y == 2018]) == 2
    # M24: the twins merge into one RQ2.1 group
    top = restaurant.top_restaurants(wh).collect()
    assert sum(1 for r in top if r.restaurant_name == "R1") == 1


def test_null_and_empty_state_collide(spark):
    # M11: (X, NULL, C) and (X, '', C) share the key 'X||C'; the NULL row wins
    from thalimart.plans.etl import build_dim_location
    locs = spark.createDataFrame([("X", "", "C", 0), ("X", None, "C", 1), ("Y", "S", "D", 2)],
                                 "country string, state string, city string, ingest_seq long")
    rows = [(r.location_key, r.location_nk, r.state) for r in
            build_dim_location(locs).orderBy("location_key").collect()]
    assert rows == [(1, "X||C", None), (2, "Y|S|D", "S")]


def test_command_line_build_and_query(tmp_path):
    import subprocess
    import sys
    d = tmp_path / "staging"
    d.mkdir()
    for name, text in [("users", USERS), ("restaurants", RESTAURANTS),
                       ("locations", LOCATIONS), ("orders", ORDERS)]:
        (d / f"{name}.csv").write_text(text)
    wh_dir, out = tmp_path / "wh", tmp_path / "out"
    env = dict(os.environ, PYTHONPATH=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    run = [sys.executable, "-m", "thalimart", "--master", "local[2]"]
    subprocess.run(run + ["build", str(d), str(wh_dir)], check=True, env=env,
                   capture_output=True, timeout=600)
    subprocess.run(run + ["sql", str(wh_dir), "SELECT COUNT(*) AS n FROM fact_order",
                          "--out", str(out), "--format", "csv"], check=True, env=env,
                   capture_output=True, timeout=600)
    text = "".join(p.read_text() for p in out.glob("*.csv"))
    assert text.split() == ["n", "9"]


def test_blank_cells_as_empty_text(spark, tmp_path):
    # M26 with the CLI import: blank cells are '' and lenient casts give 0 / 0.0
    from thalimart.plans.etl import build_dim_customer, build_dim_restaurant, staged_fact_rows
    d = tmp_path
    (d / "users.csv").write_text(USERS)
    (d / "restaurants.csv").write_text(RESTAURANTS)
    (d / "orders.csv").write_text(ORDERS)
    (d / "locations.csv").write_text(LOCATIONS)
    st = read_csv_staging(spark, str(d / "users.csv"), str(d / "restaurants.csv"),
                          str(d / "orders.csv"), str(d / "locations.csv"), blank_as_empty=True)
    cust = {r.user_id_nat: r for r in build_dim_customer(st.users).collect()}
    assert cust["5"].family_size == 0 and cust["3"].age == 0
    rest = {r.restaurant_id_nat: r for r in build_dim_restaurant(st.restaurants).collect()}
    assert rest["15"].rating == 0.0 and rest["12"].cuisine == ""
    qty = {r.order_nk: r.sales_qty for r in staged_fact_rows(st.orders).collect()}
    assert qty["5|10|2024-03-02 00:00:00|INR||10.0"] == 0


def test_no_cap_drops_orders(spark, tmp_path):
    """Ids over 2^31, amounts that differ in the fifth decimal, tiny and huge
    amounts, unequal texts and equal numbers in different spellings."""
    from thalimart.plans import etl, quality
    users = "user_id,name,email,age,gender,Family size,Monthly Income,Educational qualifications\n3000000000,A,a@x,1,F,1,,\n"
    rests = "id,name,city,rating,cuisine\n5000000000,R,Pune,1,X\n"
    cells = [("1", "10.00001"), ("1", "10.00002"), ("1", "0.00004"), ("1", "1000000000000000"), ("1", "1e30"), ("1.0", "7"),
             ("1", "7.0"), ("1", "12abc"), ("1", "12xyz"), ("1", "--"), ("4000000000", "3"), ("1", "-0.5")]
    orders = "user_id,r_id,order_date,sales_qty,sales_amount,currency\n" + "".join(
        f"3000000000,5000000000,2018-01-01 00:00:00,{q},{a},INR\n" for q, a in cells)
    for name, text in (("u", users), ("r", rests), ("o", orders), ("l", LOCATIONS)):
        (tmp_path / f"{name}.csv").write_text(text)
    st = read_csv_staging(spark, *(str(tmp_path / f"{n}.csv") for n in "urol"))
    built = build_warehouse(spark, st, str(tmp_path / "w"))
    got = sorted((r.order_nk.split("|")[4:], r.sales_qty, float(r.sales_amount)) for r in built.fact.collect())
    assert got == [(["1", "-0.5"], 1, -0.5), (["1", "0.00004"], 1, 0.00004), (["1", "10.00001"], 1, 10.00001),
                   (["1", "10.00002"], 1, 10.00002), (["1", "1000000000000000.0"], 1, 1e15), (["1", "12abc"], 1, 12.0),
                   (["1", "12xyz"], 1, 12.0), (["1", "7.0"], 1, 7.0), (["4000000000", "3.0"], 4000000000, 3.0)]
    assert quality.rejected_amounts(built).collect()[0][0] == 1
    assert quality.negative_amounts(built).collect()[0][0] == 1
    assert etl.staged_fact_rows(st.orders).count() == len(cells)


def test_orphans_count_null_keys(wh):
    from dataclasses import replace

    from pyspark.sql import functions as F

    from thalimart.plans import quality
    bad = replace(wh, orders=wh.orders.withColumns({
        "customer_key": F.when(F.col("sales_qty") == 2, F.lit(None)).otherwise(F.col("customer_key")),
        "restaurant_key": F.lit(99).cast("bigint"), "location_key": F.lit(None).cast("bigint")}))
    n, two = wh.orders.count(), wh.orders.where("sales_qty = 2").count()
    rows = {r.check_name: r.rows for r in quality.fk_orphans(bad).collect()}
    assert two > 0 and rows == {"date_fk_orphans": 0, "customer_fk_orphans": two, "restaurant_fk_orphans": n, "location_fk_orphans": 0}


def test_missing_date_has_no_text(spark):
    from thalimart.functions.lenient import iso_timestamp, ntz_text
    from pyspark.sql import functions as F
    row = spark.createDataFrame([("bad",)], "d string").select(ntz_text(iso_timestamp(F.col("d"))).alias("t")).first()
    assert row.t is None
