"""Research question 2: restaurant performance - top sellers, the Oct-Nov
festival season, rating tiers and cuisines.

Top-k lists use ``orderBy(...).limit(k)`` (each task keeps its own k, then
one merge); every sort ends in the group keys so ties resolve the same way
on every run. Unrounded averages are reported to 6 decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import buckets as B
from ..functions.numeric import avg_money, money_round, out_money
from ..operators.topk import rows_at_group_max
from .warehouse import Warehouse

FESTIVAL_YEARS = (2017, 2018, 2019)
FESTIVAL_MONTHS = (10, 11)


def top_restaurants(wh: Warehouse) -> DataFrame:
    """RQ2.1: top 10 (name, location city, country, cuisine, rating) groups by
    sales; same-named restaurants with equal attributes merge."""
    g = wh.located_orders.groupBy("restaurant_name", "loc_city", "loc_country", "cuisine",
                                  "rating").agg(
        F.avg("rating").alias("avg_rating_raw"),
        F.count("order_key").alias("total_orders"),
        F.sum("sales_amount").alias("sales"),
        avg_money(F.col("sales_amount")).alias("aov"))
    return (g.orderBy(F.col("sales").desc(), F.col("avg_rating_raw").desc_nulls_last(),
                      "restaurant_name", "loc_city", "loc_country",
                      F.col("cuisine").asc_nulls_first(), F.col("rating").asc_nulls_first())
            .limit(10)
            .select(F.col("restaurant_name"), F.col("loc_city").alias("city"),
                    F.col("loc_country").alias("country"), "cuisine",
                    money_round(F.col("avg_rating_raw"), 6).alias("avg_rating"),
                    "total_orders", out_money(F.col("sales")).alias("total_sales"),
                    money_round(F.col("aov"), 6).alias("avg_order_value")))


def festival_top(wh: Warehouse, ordered: bool = True) -> DataFrame:
    """RQ2.2: per festival year, the restaurant group(s) with the highest
    Oct-Nov sales (ties kept). The year filter prunes fact partitions."""
    season = wh.located_orders.where(F.col("year").isin(*FESTIVAL_YEARS)
                                     & F.col("month").isin(*FESTIVAL_MONTHS))
    g = season.groupBy("restaurant_key", "restaurant_name", "loc_city", "cuisine", "rating",
                       "year").agg(F.count("order_key").alias("total_orders"),
                                   F.sum("sales_amount").alias("sales"))
    # one maximum per festival year: at most len(FESTIVAL_YEARS) rows
    best = rows_at_group_max(g, ["year"], "sales", groups_bounded=True)
    if ordered:
        best = best.orderBy(F.col("year").desc(), "restaurant_key")
    return best.select("restaurant_key", "restaurant_name", F.col("loc_city").alias("city"),
                       "cuisine", "rating", "year", "total_orders",
                       out_money(F.col("sales")).alias("total_sales"))


def rating_tiers(wh: Warehouse) -> DataFrame:
    """RQ2.3: orders and revenue per rating tier (NULL rating is 'Below Average')."""
    g = wh.orders.withColumn("rating_tier", B.rating_tier(F.col("rating"))) \
        .groupBy("rating_tier").agg(
            F.countDistinct("restaurant_key").alias("restaurant_count"),
            F.count("order_key").alias("total_orders"),
            F.sum("sales_amount").alias("revenue"),
            avg_money(F.col("sales_amount")).alias("aov"))
    return (g.select("rating_tier", "restaurant_count", "total_orders",
                     out_money(F.col("revenue")).alias("total_revenue"),
                     money_round(F.col("aov"), 2).alias("avg_order_value"))
            .orderBy(F.col("avg_order_value").desc_nulls_last(), "rating_tier"))


def cuisine_performance(wh: Warehouse) -> DataFrame:
    """RQ2.4: top 15 cuisine strings (unsplit; NULL is its own group) by revenue."""
    g = wh.orders.groupBy("cuisine").agg(
        F.countDistinct("restaurant_key").alias("restaurant_count"),
        F.count("order_key").alias("total_orders"),
        F.sum("sales_amount").alias("revenue"),
        avg_money(F.col("sales_amount")).alias("aov"),
        F.avg("rating").alias("avg_rating"))
    return (g.orderBy(F.col("revenue").desc(), F.col("cuisine").asc_nulls_first()).limit(15)
            .select("cuisine", "restaurant_count", "total_orders",
                    out_money(F.col("revenue")).alias("total_revenue"),
                    money_round(F.col("aov"), 2).alias("avg_order_value"),
                    money_round(F.col("avg_rating"), 2).alias("avg_restaurant_rating")))
