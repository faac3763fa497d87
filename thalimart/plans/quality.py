"""Post-load QA checks and source data-quality checks.

The orphan and uniqueness checks read every table once: its keys are stacked
into (check, key) rows, counted per key with partial aggregation (one row per
distinct key and task), and only these counts are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import etl
from .warehouse import Warehouse


def _count_row(df: DataFrame, label_col: str, label: str, count_col: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(count_col)).select(
        F.lit(label).alias(label_col), count_col)


def row_counts(wh: Warehouse) -> DataFrame:
    """Q1: rows per warehouse table (t, c)."""
    tables = [("fact_order", wh.fact), ("dim_customer", wh.dim_customer),
              ("dim_restaurant", wh.dim_restaurant), ("dim_date", wh.dim_date),
              ("dim_location", wh.dim_location)]
    parts = [_count_row(df.select(F.lit(1).alias("_x")), "t", name, "c") for name, df in tables]
    return reduce(DataFrame.unionByName, parts)


def _stacked(df: DataFrame, keys: dict[str, str]) -> DataFrame:
    """(check_name, key) rows of the named columns, one scan."""
    pairs = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(c).cast("string").alias("key"))
                      for name, c in keys.items()])
    return df.select(F.inline(pairs))


def _for_each_check(names: list[str], found: DataFrame, value: str) -> DataFrame:
    """``found`` (check_name, value) with a 0 for checks without a row."""
    spark = found.sparkSession
    labels = spark.range(1).select(F.explode(F.array(*map(F.lit, names))).alias("check_name"))
    return labels.join(found, "check_name", "left").select(
        "check_name", F.coalesce(value, F.lit(0)).cast("bigint").alias(value))


def fk_orphans(wh: Warehouse) -> DataFrame:
    """Q2: fact rows whose foreign key has no dimension row (expected 0). A NULL
    key is an orphan too, except the location, which may be unknown."""
    keys = {"date_fk_orphans": ("date_key", wh.dim_date), "customer_fk_orphans": ("customer_key", wh.dim_customer),
            "restaurant_fk_orphans": ("restaurant_key", wh.dim_restaurant),
            "location_fk_orphans": ("location_key", wh.dim_location)}
    used = _stacked(wh.fact, {name: c for name, (c, _) in keys.items()})
    used = (used.where(F.col("key").isNotNull() | (F.col("check_name") != "location_fk_orphans"))
            .groupBy("check_name", "key").agg(F.count(F.lit(1)).alias("n")))
    have = reduce(DataFrame.unionByName, [_stacked(dim, {name: c}) for name, (c, dim) in keys.items()])
    missing = used.join(have, ["check_name", "key"], "left_anti")
    return _for_each_check(list(keys), missing.groupBy("check_name").agg(F.sum("n").alias("rows")), "rows")


def location_count(wh: Warehouse) -> DataFrame:
    """Q3."""
    return wh.dim_location.agg(F.count(F.lit(1)).alias("dim_location_rows"))


def location_sample(wh: Warehouse) -> DataFrame:
    """Q4: first 20 locations by country, state, city."""
    return (wh.dim_location.orderBy("country", F.col("state").asc_nulls_first(), "city")
            .limit(20).select("location_key", "country", "state", "city"))


def duplicate_users(wh: Warehouse) -> DataFrame:
    """Q5: staged user ids loaded more than once."""
    return (wh.staging.users.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1).orderBy("user_id"))


def invalid_dates(wh: Warehouse) -> DataFrame:
    """Q6: NULL or empty order dates, plus dates that do not parse as ISO."""
    d = F.col("order_date")
    return etl.parsed_orders(wh.staging.order_cells).agg(
        F.count(F.when(d.isNull() | (d == ""), 1)).alias("invalid_dates"),
        F.count(F.when(d.isNotNull() & (d != "") & F.col("p_ts").isNull(), 1))
        .alias("unparseable_dates"))


def negative_amounts(wh: Warehouse) -> DataFrame:
    """Q7: staged orders with an amount below zero."""
    return etl.parsed_orders(wh.staging.order_cells).agg(
        F.count(F.when(F.col("p_amount") < 0, 1)).alias("negative_amounts"))


def null_keys(wh: Warehouse) -> DataFrame:
    """Q8: NULL staged user ids and restaurant ids (check_name, rows)."""
    u = wh.staging.users.agg(F.count(F.when(F.col("user_id").isNull(), 1)).alias("rows")) \
        .select(F.lit("null_user_ids").alias("check_name"), "rows")
    r = wh.staging.restaurants.agg(F.count(F.when(F.col("id").isNull(), 1)).alias("rows")) \
        .select(F.lit("null_restaurant_ids").alias("check_name"), "rows")
    return u.unionByName(r)


def unique_keys(wh: Warehouse) -> DataFrame:
    """Q9: natural and surrogate keys that occur more than once (expected 0)."""
    tables = {"dim_date": (wh.dim_date, ("date_key", "date_iso")),
              "dim_customer": (wh.dim_customer, ("customer_key", "user_id_nat")),
              "dim_restaurant": (wh.dim_restaurant, ("restaurant_key", "restaurant_id_nat")),
              "dim_location": (wh.dim_location, ("location_key", "location_nk")),
              "fact_order": (wh.fact, ("order_key", "order_nk"))}
    names = [f"{t}.{c}" for t, (_, cols) in tables.items() for c in cols]
    rows = reduce(DataFrame.unionByName, [_stacked(df, {f"{t}.{c}": c for c in cols}) for t, (df, cols) in tables.items()])
    per_key = rows.where(F.col("key").isNotNull()).groupBy("check_name", "key").agg(F.count(F.lit(1)).alias("n"))
    found = per_key.where("n > 1").groupBy("check_name").agg(F.count(F.lit(1)).alias("duplicate_keys"))
    return _for_each_check(names, found, "duplicate_keys")


def rejected_amounts(wh: Warehouse) -> DataFrame:
    """Q10: otherwise valid staged orders whose amount the fact cannot hold."""
    return etl.rejected_amounts(wh.staging.order_cells)
