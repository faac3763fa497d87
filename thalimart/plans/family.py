"""Research question 3: family size x income x weekday/weekend/holiday.

``family_view`` is the analysis view (one row per order). Because the
warehouse fact already carries the customer, date and restaurant attributes,
the view is a projection of the fact - no join at query time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import buckets as B
from ..functions.numeric import avg_money, money_round, out_money, percent
from .warehouse import Warehouse


def family_view(wh: Warehouse) -> DataFrame:
    """RQ3.1: order_key, sales_qty, sales_amount, family_group, income_level,
    is_weekend, is_holiday, cuisine."""
    return wh.orders.select(
        "order_key", "sales_qty", out_money(F.col("sales_amount")).alias("sales_amount"),
        B.family_group(F.col("family_size")).alias("family_group"),
        B.income_level(F.col("income_group")).alias("income_level"),
        "is_weekend", "is_holiday", "cuisine")


def _family_base(wh: Warehouse) -> DataFrame:
    """The view with the exact DECIMAL amount kept for summing."""
    return wh.orders.select(
        "order_key", "sales_qty", "sales_amount",
        B.family_group(F.col("family_size")).alias("family_group"),
        B.income_level(F.col("income_group")).alias("income_level"),
        "is_weekend", "is_holiday", "cuisine")


def _measures():
    return [F.count("order_key").alias("orders"),
            F.sum("sales_qty").cast("bigint").alias("total_sales_quantity"),
            F.sum("sales_amount").alias("amount"),
            avg_money(F.col("sales_amount")).alias("aov")]


def _finish(g: DataFrame, keys: list[str], ordered: bool = True) -> DataFrame:
    out = g.select(*keys, "orders", "total_sales_quantity",
                   out_money(F.col("amount")).alias("total_sales_amount"),
                   money_round(F.col("aov"), 2).alias("avg_order_value"))
    if ordered:
        out = out.orderBy(F.col("total_sales_amount").desc(),
                          F.col("total_sales_quantity").desc(), *keys)
    return out


def family_daytype(wh: Warehouse, ordered: bool = True) -> DataFrame:
    """RQ3.2: by family group, income level and weekday/weekend."""
    g = (_family_base(wh).groupBy("family_group", "income_level", "is_weekend").agg(*_measures())
         .withColumn("day_type", B.weekend_label(F.col("is_weekend"))))
    return _finish(g, ["family_group", "income_level", "day_type"], ordered)


def family_holiday(wh: Warehouse, ordered: bool = True) -> DataFrame:
    """RQ3.3: by family group, income level and holiday / regular day."""
    g = (_family_base(wh).groupBy("family_group", "income_level", "is_holiday").agg(*_measures())
         .withColumn("day_type", B.holiday_label(F.col("is_holiday"))))
    return _finish(g, ["family_group", "income_level", "day_type"], ordered)


def family_cuisine(wh: Warehouse) -> DataFrame:
    """RQ3.4: top 20 (cuisine, family, income, day type) groups by sales."""
    base = _family_base(wh).where(F.col("cuisine").isNotNull() & F.col("is_weekend").isNotNull()
                                  & F.col("sales_qty").isNotNull()
                                  & F.col("sales_amount").isNotNull())
    g = (base.groupBy("cuisine", "family_group", "income_level", "is_weekend").agg(*_measures())
         .withColumn("day_type", B.weekend_label(F.col("is_weekend"))))
    keys = ["cuisine", "family_group", "income_level", "day_type"]
    return (g.orderBy(F.col("amount").desc(), *keys).limit(20)
            .select(*keys, "orders", "total_sales_quantity",
                    out_money(F.col("amount")).alias("total_sales_amount"),
                    money_round(F.col("aov"), 2).alias("avg_order_value")))


def family_revenue_share(wh: Warehouse) -> DataFrame:
    """RQ3.5: revenue share of each family x income segment.

    ``COUNT(DISTINCT order_key)`` is a plain count: order_key is the fact's
    primary key (checked by ``dq_unique_keys``), so no distinct shuffle."""
    g = _family_base(wh).groupBy("family_group", "income_level").agg(
        F.count("order_key").alias("total_orders"),
        F.sum("sales_amount").alias("revenue"),
        avg_money(F.col("sales_amount")).alias("aov"))
    total = F.sum("revenue").over(Window.partitionBy())
    return (g.select("family_group", "income_level", "total_orders",
                     out_money(F.col("revenue")).alias("total_revenue"),
                     money_round(F.col("aov"), 2).alias("avg_order_value"),
                     percent(out_money(F.col("revenue")), out_money(total)).alias("revenue_percentage"))
            .orderBy(F.col("total_revenue").desc(), "family_group", "income_level"))
