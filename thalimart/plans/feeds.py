"""Chart feeds: the data shaping under each published chart, read straight
from the query DataFrames (rendering itself is not part of the engine).

Every feed works on an already-aggregated query result (at most a few
hundred rows), so its extra windows and pivots are cheap at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.buckets import EDUCATION_GROUPS, INCOME_GROUPS
from ..functions.numeric import money_round, percent
from . import customer, family, restaurant
from .warehouse import Warehouse

BOX_PROBS = (0.0, 0.25, 0.5, 0.75, 1.0)
BOX_COLS = ("aov_min", "aov_q1", "aov_median", "aov_q3", "aov_max")


def _slug(label: str) -> str:
    out = "".join(ch.lower() if ch.isalnum() else "_" for ch in label)
    while "__" in out:
        out = out.replace("__", "_")
    return out.strip("_")


def income_mix(wh: Warehouse) -> DataFrame:
    """Income segments by customer count (desc) with donut shares and a
    thousands-separated label."""
    q = customer.income_frequency(wh, ordered=False)
    total = F.sum("customer_count").over(Window.partitionBy())
    return (q.select("income_group", "customer_count",
                     percent(F.col("customer_count"), total).alias("share_pct"),
                     F.format_number(F.col("customer_count"), 0).alias("customer_count_label"))
            .orderBy(F.col("customer_count").desc(), "income_group"))


def avg_orders_range(wh: Warehouse) -> DataFrame:
    """Axis range of average orders per customer across income groups."""
    q = customer.income_frequency(wh, ordered=False)
    return q.agg(F.min("avg_orders_per_customer").alias("min_avg_orders"),
                 F.max("avg_orders_per_customer").alias("max_avg_orders"))


def _pivot(q: DataFrame, row: str, col: str, labels: tuple[str, ...]) -> DataFrame:
    p = q.groupBy(row).pivot(col, list(labels)).agg(F.max("percentage"))
    return p.select(row, *[F.col(f"`{lab}`").alias(f"pct_{_slug(lab)}") for lab in labels]) \
        .orderBy(row)


def cuisine_pivot_education(wh: Warehouse) -> DataFrame:
    """Heat map: top cuisine x education group, percentage."""
    return _pivot(customer.cuisine_by_education(wh, ordered=False), "top_cuisine", "education_group",
                  EDUCATION_GROUPS)


def cuisine_pivot_income(wh: Warehouse) -> DataFrame:
    """Heat map: cuisine x income group, percentage."""
    return _pivot(customer.cuisine_by_income(wh, ordered=False), "single_cuisine", "income_group", INCOME_GROUPS)


def _box(q: DataFrame, keys: list[str]) -> DataFrame:
    stats = F.percentile(F.col("avg_order_value"), F.array(*[F.lit(p) for p in BOX_PROBS]))
    g = q.groupBy(*keys).agg(stats.alias("_q"))
    return g.select(*keys, *[money_round(F.col("_q")[i], 6).alias(name)
                             for i, name in enumerate(BOX_COLS)]).orderBy(*keys)


def aov_box_daytype(wh: Warehouse) -> DataFrame:
    """Box plot of segment AOV by weekday/weekend."""
    return _box(family.family_daytype(wh, ordered=False), ["day_type"])


def aov_box_income_holiday(wh: Warehouse) -> DataFrame:
    """Box plot of segment AOV by income level x holiday/regular day."""
    return _box(family.family_holiday(wh, ordered=False), ["income_level", "day_type"])


def aov_weekday(wh: Warehouse) -> DataFrame:
    """Weekday rows only: mean AOV per family group x income level."""
    q = family.family_daytype(wh, ordered=False).where(F.col("day_type") == "Weekday")
    return (q.groupBy("family_group", "income_level")
            .agg(money_round(F.avg("avg_order_value"), 6).alias("mean_aov"))
            .orderBy("family_group", "income_level"))


def aov_holiday(wh: Warehouse) -> DataFrame:
    """AOV per family group x holiday flag, averaged over income levels."""
    q = family.family_holiday(wh, ordered=False)
    return (q.groupBy("family_group", "day_type")
            .agg(money_round(F.avg("avg_order_value"), 6).alias("mean_aov"))
            .orderBy("family_group", "day_type"))


def top_restaurants(wh: Warehouse) -> DataFrame:
    """Bar feed: the top-10 list ranked by sales, with AOV."""
    q = restaurant.top_restaurants(wh)
    w = Window.orderBy(F.col("total_sales").desc(), F.col("avg_rating").desc_nulls_last(),
                       "restaurant_name", "city", "country", F.col("cuisine").asc_nulls_first())
    return q.select(F.row_number().over(w).cast("bigint").alias("sales_rank"), "restaurant_name", "city",
                    "total_sales", "avg_order_value").orderBy("sales_rank")


def rating_vs_orders(wh: Warehouse) -> DataFrame:
    """Scatter feed: rating against order count for the top-10 list."""
    return restaurant.top_restaurants(wh).select("restaurant_name", "city", "avg_rating",
                                                 "total_orders")


def festival_by_year(wh: Warehouse) -> DataFrame:
    """Line feed: best festival sales per year (mean over tied rows)."""
    q = restaurant.festival_top(wh, ordered=False)
    return (q.groupBy("year").agg(money_round(F.avg("total_sales"), 6).alias("avg_total_sales"))
            .orderBy("year"))
