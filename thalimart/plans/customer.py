"""Research question 1: customer demographics (income, education) versus order
frequency, spending and cuisine preference.

Scale notes: the fact is aggregated to customer grain (partial aggregation)
before any customer-grain join, and cuisine counts are taken per cuisine
*string* before splitting, so explode and windows run over small
aggregated frames, never over order rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import money_round, out_money, percent, safe_div
from ..operators import cuisine as C
from ..operators.topk import top_n_per_group, with_group_total
from .warehouse import Warehouse


def _orders_per_customer(wh: Warehouse) -> DataFrame:
    return wh.orders.groupBy("customer_key").agg(
        F.count("order_key").alias("n_orders"), F.sum("sales_amount").alias("spend"))


def _customers_with_orders(wh: Warehouse) -> DataFrame:
    """dim_customer LEFT JOIN fact, at customer grain (one row per customer)."""
    return wh.dim_customer.select("customer_key", "income_group", "income_group_order") \
        .join(_orders_per_customer(wh), "customer_key", "left")


def income_distribution(wh: Warehouse) -> DataFrame:
    """RQ1.1: customers per income group and share of all customers."""
    g = wh.dim_customer.groupBy("income_group", "income_group_order") \
        .agg(F.count(F.lit(1)).alias("customer_count"))
    total = F.sum("customer_count").over(Window.partitionBy())
    return (g.select("income_group", "customer_count",
                     percent(F.col("customer_count"), total).alias("percentage"),
                     "income_group_order")
            .orderBy("income_group_order", "income_group").drop("income_group_order"))


def income_frequency(wh: Warehouse, ordered: bool = True) -> DataFrame:
    """RQ1.2: customers (with or without orders), orders, orders per customer.
    ``ordered=False`` skips the presentation sort (for feeds that re-aggregate)."""
    g = _customers_with_orders(wh).groupBy("income_group", "income_group_order").agg(
        F.count("customer_key").alias("customer_count"),
        F.coalesce(F.sum("n_orders"), F.lit(0)).cast("bigint").alias("total_orders"))
    out = g.select("income_group", "customer_count", "total_orders",
                   money_round(safe_div(F.col("total_orders"), F.col("customer_count")), 2)
                   .alias("avg_orders_per_customer"), "income_group_order")
    if ordered:
        out = out.orderBy("income_group_order", "income_group")
    return out.drop("income_group_order")


def income_spending(wh: Warehouse) -> DataFrame:
    """RQ1.3: spend per income group; per-customer average divides by *all*
    customers of the group, ordering or not."""
    g = _customers_with_orders(wh).groupBy("income_group", "income_group_order").agg(
        F.coalesce(F.sum("n_orders"), F.lit(0)).cast("bigint").alias("order_count"),
        F.sum("spend").alias("spend"),
        F.count("customer_key").alias("customers"))
    return (g.select(
        "income_group", "order_count",
        money_round(F.col("spend"), 2).alias("total_spending"),
        money_round(safe_div(F.col("spend"), F.col("order_count")), 2).alias("avg_order_value"),
        money_round(safe_div(F.col("spend"), F.col("customers")), 2)
        .alias("avg_spending_per_customer"),
        "income_group_order")
        .orderBy("income_group_order", "income_group").drop("income_group_order"))


def cuisine_by_income(wh: Warehouse, ordered: bool = True) -> DataFrame:
    """RQ1.4: top 5 cuisines per income group. Every split element counts
    (empties and repeats too); shares are over *all* cuisines of the group."""
    per_string = wh.orders.groupBy("income_group", "income_group_order", "cuisine") \
        .agg(F.count(F.lit(1)).alias("n"))
    items = per_string.select("income_group", "income_group_order", "n",
                              F.explode(C.all_items(F.col("cuisine"))).alias("single_cuisine"))
    counts = items.groupBy("income_group", "income_group_order", "single_cuisine") \
        .agg(F.sum("n").cast("bigint").alias("order_count"))
    shared = with_group_total(counts, ["income_group"], "order_count", "_group_total") \
        .withColumn("percentage", percent(F.col("order_count"), F.col("_group_total"))) \
        .drop("_group_total")
    ranked = top_n_per_group(shared, ["income_group"],
                             [F.col("order_count").desc(), F.col("single_cuisine").asc()], 5)
    if ordered:
        ranked = ranked.orderBy("income_group_order", F.col("order_count").desc(),
                                "single_cuisine")
    return ranked.select("income_group", "single_cuisine", "order_count", "percentage")


def education_behaviour(wh: Warehouse) -> DataFrame:
    """RQ1.5: ordering customers, orders and spend per education group."""
    g = wh.orders.groupBy("education_group", "education_group_order").agg(
        F.countDistinct("customer_key").alias("customer_count"),
        F.count("order_key").alias("total_orders"),
        F.sum("sales_amount").alias("spend"))
    return (g.select(
        "education_group", "customer_count", "total_orders",
        money_round(safe_div(F.col("total_orders"), F.col("customer_count")), 2)
        .alias("avg_orders_per_customer"),
        out_money(F.col("spend")).alias("total_sales"),
        money_round(safe_div(F.col("spend"), F.col("customer_count")), 2)
        .alias("avg_spend_per_customer"),
        "education_group_order")
        .orderBy("education_group_order", "education_group").drop("education_group_order"))


def cuisine_by_education(wh: Warehouse, ordered: bool = True) -> DataFrame:
    """RQ1.6: top 5 cuisines per education group by distinct orders; shares
    are over the five kept rows only."""
    per_string = (wh.orders.where(F.col("cuisine").isNotNull())
                  .groupBy("education_group", "education_group_order", "cuisine")
                  .agg(F.count(F.lit(1)).alias("n")))
    items = per_string.select("education_group", "education_group_order", "n",
                              F.explode(C.distinct_nonempty_items(F.col("cuisine")))
                              .alias("single_cuisine"))
    counts = items.groupBy("education_group", "education_group_order", "single_cuisine") \
        .agg(F.sum("n").cast("bigint").alias("order_count"))
    ranked = top_n_per_group(counts, ["education_group"],
                             [F.col("order_count").desc(), F.col("single_cuisine").asc()], 5,
                             rank_col="_pos")
    share = percent(F.col("order_count"),
                    F.sum("order_count").over(Window.partitionBy("education_group")))
    out = ranked.withColumn("percentage", share)
    if ordered:
        out = out.orderBy("education_group_order", "education_group", "_pos")
    return out.select("education_group", F.col("single_cuisine").alias("top_cuisine"),
                      "order_count", "percentage")


def weekend_by_education(wh: Warehouse) -> DataFrame:
    """RQ1.7: weekday/weekend split of orders per education group."""
    g = wh.orders.groupBy("education_group", "education_group_order", "is_weekend") \
        .agg(F.count("order_key").alias("order_count"))
    share = percent(F.col("order_count"),
                    F.sum("order_count").over(Window.partitionBy("education_group")))
    return (g.select("education_group",
                     F.when(F.col("is_weekend") == 1, "Weekend").otherwise("Weekday").alias("day_type"),
                     "order_count", share.alias("percentage"),
                     "education_group_order", "is_weekend")
            .orderBy("education_group_order", "education_group", "is_weekend")
            .drop("education_group_order", "is_weekend"))
