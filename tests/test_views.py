"""Plain SQL over the registered views against the DataFrame API."""

from __future__ import annotations

from pyspark.sql import functions as F

from thalimart.plans.views import VIEWS, register_views
from thalimart.plans.warehouse import warehouse_for

SF = "/root/testdata/sf0.001"


def test_views_answer_sql_as_the_api_does(spark):
    wh = warehouse_for(spark, SF)
    assert set(register_views(spark, wh)) == set(VIEWS)
    bulk = spark.sql("""
        SELECT gender, quarter, max(sales_qty) AS largest, sum(sales_qty) AS units
        FROM fact_order NATURAL JOIN dim_customer NATURAL JOIN (SELECT date_key, quarter FROM dim_date)
        WHERE age BETWEEN 30 AND 45 AND currency = 'INR' GROUP BY gender, quarter""")
    ages = wh.dim_customer.where("age >= 30 and age <= 45").select("customer_key", "gender")
    want = (wh.orders.where("currency = 'INR'").join(ages, "customer_key").groupBy("gender", "quarter")
            .agg(F.max("sales_qty").alias("largest"), F.sum("sales_qty").alias("units")))
    assert sorted(map(str, bulk.collect())) == sorted(map(str, want.collect()))
    nowhere = spark.sql("SELECT count(*) FROM fact_order WHERE location_key IS NULL").first()[0]
    assert nowhere == wh.orders.where("loc_city is null").count()
    big = spark.sql("SELECT count(*) FROM v_family_analysis WHERE family_group = '2 members' AND is_weekend = 1").first()[0]
    assert big == wh.orders.where("family_size = 2 and dow in (1, 7)").count()


def test_load_views(spark):
    wh = warehouse_for(spark, SF)
    register_views(spark, wh)
    assert spark.table("v_stg_orders_nk").count() == wh.staging.orders.count()
    assert spark.table("v_new_dates").exceptAll(wh.dim_date).isEmpty()
    loaded = spark.sql("SELECT count(DISTINCT order_nk) FROM v_fact_load WHERE abs(sales_amount) < 1e18").first()[0]
    kept = wh.fact.count()
    assert loaded >= kept and spark.table("v_fact_load").join(wh.fact, "order_nk", "left_semi").count() >= kept
