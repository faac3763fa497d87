"""Business insight queries (BI1-BI5) and the two README sample queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import buckets as B
from ..functions.numeric import avg_money, money_round, out_money, percent
from .warehouse import Warehouse


def monthly_revenue(wh: Warehouse) -> DataFrame:
    """BI1: orders, revenue, AOV and distinct customers per calendar month."""
    g = wh.orders.groupBy("year", "month", "month_name").agg(
        F.count("order_key").alias("total_orders"),
        F.sum("sales_amount").alias("revenue"),
        avg_money(F.col("sales_amount")).alias("aov"),
        F.countDistinct("customer_key").alias("unique_customers"))
    return (g.select("year", "month", "month_name", "total_orders",
                     out_money(F.col("revenue")).alias("total_revenue"),
                     money_round(F.col("aov"), 2).alias("avg_order_value"), "unique_customers")
            .orderBy("year", "month"))


def loyalty(wh: Warehouse) -> DataFrame:
    """BI2: customers with at least one order, by repeat-purchase segment.
    ``avg_order_value`` is the mean of per-customer means."""
    per_customer = wh.orders.groupBy("customer_key").agg(
        F.count("order_key").alias("total_orders"),
        F.sum("sales_amount").alias("total_spent"),
        avg_money(F.col("sales_amount")).alias("avg_order_value"))
    return loyalty_segments(per_customer)


def loyalty_segments(per_customer: DataFrame) -> DataFrame:
    """BI2 from total_orders, total_spent, avg_order_value of every customer."""
    seg = per_customer.withColumn("customer_segment", B.loyalty_segment(F.col("total_orders")))
    g = seg.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.avg("total_orders").alias("avg_orders"),
        avg_money(F.col("total_spent")).alias("avg_spent"),
        F.avg("avg_order_value").alias("avg_aov"))
    return (g.select("customer_segment", "customer_count",
                     money_round(F.col("avg_orders"), 1).alias("avg_orders_per_customer"),
                     money_round(F.col("avg_spent"), 2).alias("avg_total_spent"),
                     money_round(F.col("avg_aov"), 2).alias("avg_order_value"))
            .orderBy(F.col("avg_total_spent").desc(), "customer_segment"))


def geography(wh: Warehouse) -> DataFrame:
    """BI3: top 20 (country, state, city) by revenue; orders without a matched
    location drop out."""
    g = wh.located_orders.groupBy("loc_country", "loc_state", "loc_city").agg(
        F.countDistinct("restaurant_key").alias("restaurant_count"),
        F.count("order_key").alias("total_orders"),
        F.sum("sales_amount").alias("revenue"),
        avg_money(F.col("sales_amount")).alias("aov"),
        F.avg("rating").alias("avg_rating"))
    return (g.orderBy(F.col("revenue").desc(), "loc_country",
                      F.col("loc_state").asc_nulls_first(), "loc_city").limit(20)
            .select(F.col("loc_country").alias("country"), F.col("loc_state").alias("state"),
                    F.col("loc_city").alias("city"), "restaurant_count", "total_orders",
                    out_money(F.col("revenue")).alias("total_revenue"),
                    money_round(F.col("aov"), 2).alias("avg_order_value"),
                    money_round(F.col("avg_rating"), 2).alias("avg_restaurant_rating")))


def seasonality(wh: Warehouse) -> DataFrame:
    """BI4: all years merged, per quarter and month: share of total revenue."""
    g = wh.orders.groupBy("quarter", "month", "month_name").agg(
        F.count("order_key").alias("total_orders"),
        F.sum("sales_amount").alias("revenue"),
        avg_money(F.col("sales_amount")).alias("aov"))
    total = out_money(F.sum("revenue").over(Window.partitionBy()))
    return (g.select("quarter", "month_name", "total_orders",
                     out_money(F.col("revenue")).alias("total_revenue"),
                     money_round(F.col("aov"), 2).alias("avg_order_value"),
                     percent(out_money(F.col("revenue")), total).alias("revenue_percentage"),
                     "month")
            .orderBy("quarter", "month").drop("month"))


def acquisition(wh: Warehouse) -> DataFrame:
    """BI5: new customers per (first year, first month) and the running total.
    Year and month minima are taken independently, as the source does."""
    first = wh.orders.groupBy("customer_key").agg(
        F.min("year").alias("first_order_year"), F.min("month").alias("first_order_month"))
    return acquisition_totals(first)


def acquisition_totals(first: DataFrame) -> DataFrame:
    """BI5 from first_order_year, first_order_month of every customer."""
    g = first.groupBy("first_order_year", "first_order_month") \
        .agg(F.count(F.lit(1)).alias("new_customers"))
    running = Window.orderBy("first_order_year", "first_order_month") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (g.withColumn("cumulative_customers", F.sum("new_customers").over(running))
            .orderBy("first_order_year", "first_order_month"))


def readme_income_spend(wh: Warehouse) -> DataFrame:
    """README sample 1: order rows and average order value per income group."""
    g = wh.orders.groupBy("income_group").agg(
        F.count(F.lit(1)).alias("customer_count"), avg_money(F.col("sales_amount")).alias("aov"))
    return (g.select("income_group", "customer_count",
                     money_round(F.col("aov"), 2).alias("avg_spending"))
            .orderBy(F.col("avg_spending").desc(), "income_group"))


def readme_top_restaurants(wh: Warehouse) -> DataFrame:
    """README sample 2: top 10 (name, location city, cuisine) by sales; the
    rating is averaged over order rows, not grouped."""
    g = wh.located_orders.groupBy("restaurant_name", "loc_city", "cuisine").agg(
        F.avg("rating").alias("avg_rating_raw"), F.sum("sales_amount").alias("sales"))
    return (g.orderBy(F.col("sales").desc(), "restaurant_name", "loc_city",
                      F.col("cuisine").asc_nulls_first()).limit(10)
            .select("restaurant_name", F.col("loc_city").alias("city"), "cuisine",
                    money_round(F.col("avg_rating_raw"), 6).alias("avg_rating"),
                    out_money(F.col("sales")).alias("total_sales")))
