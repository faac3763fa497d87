"""Stored partial aggregates that every batch of new orders is merged into.

Three states answer the growing reports without reading the fact again:

* ``months``: orders, revenue and amounts per calendar month (BI1);
* ``customers``: orders, spending and first year and month per customer (BI2, BI5);
* ``visitors``: the customers of a month as bitmaps over the dense customer keys,
  one row per month and bucket of 32,768 keys. Bitmaps merge by OR, so the exact
  distinct customers of months, quarters, years or any other span come from the
  one state: no key is shuffled and no row is expanded per level.

A state is a chain of pieces. A piece holds the partial aggregates of the orders
whose keys lie after its first and up to its last number, which its folder's name
tells (``00..0-00..9``). Order keys are dense and later orders get larger ones, so

* an update aggregates only orders after the chain's end (row groups of older
  orders are skipped by their statistics) and adds one piece;
* a batch that is replayed adds no order, hence nothing; a piece that was not
  finished has no ``_SUCCESS`` and is written again by the next update;
* readers follow the chain from 0, always by the longest piece, and merge.

After ``COMPACT_AFTER`` pieces one piece from 0 replaces them: readers see it when
it is complete, and only then the others go.

The bitmaps of a task are as many as the months and buckets that its rows touch;
batches and files ordered by time keep that small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import money_round, out_money, safe_div
from . import business
from .warehouse import Warehouse, complete_folders, remove

COMPACT_AFTER = 8


@dataclass(frozen=True)
class State:
    """``measures``: name -> (aggregate of orders, how partial values merge)."""

    keys: dict[str, Column]
    measures: dict[str, tuple]

    def partial(self, orders: DataFrame) -> DataFrame:
        keyed = orders.withColumns(self.keys)
        return keyed.groupBy(*self.keys).agg(*(first().alias(name) for name, (first, _) in self.measures.items()))

    def merged(self, pieces: DataFrame) -> DataFrame:
        return pieces.groupBy(*self.keys).agg(*(merge(name).alias(name) for name, (_, merge) in self.measures.items()))


def _states() -> dict[str, State]:
    def same(*names: str) -> dict[str, Column]:
        return {n: F.col(n) for n in names}

    amounts = {"orders": (lambda: F.count("order_key"), F.sum), "revenue": (lambda: F.sum("sales_amount"), F.sum),
               "amounts": (lambda: F.count("sales_amount"), F.sum)}
    firsts = {"first_order_year": (lambda: F.min("year"), F.min), "first_order_month": (lambda: F.min("month"), F.min)}
    bits = {"bitmap": (lambda: F.bitmap_construct_agg(F.bitmap_bit_position("customer_key")), F.bitmap_or_agg)}
    return {"months": State(same("year", "month", "month_name"), amounts), "customers": State(same("customer_key"), amounts | firsts),
            "visitors": State(same("year", "quarter", "month") | {"bucket": F.bitmap_bucket_number("customer_key")}, bits)}


def _chain(spark: SparkSession, path: str) -> list[tuple[int, int, str]]:
    """The pieces that cover the orders from the first on: (after, up to, name)."""
    found: dict[int, tuple[int, str]] = {}
    for name in complete_folders(spark, path):
        after, last = map(int, name.split("-"))
        found[after] = max(found.get(after, (0, "")), (last, name))
    chain, at = [], 0
    while at in found:
        last, name = found[at]
        chain.append((at, last, name))
        at = last
    return chain


def kept(spark: SparkSession, root: str) -> bool:
    return any(_chain(spark, f"{root}/state/{name}") for name in _states())


def update(spark: SparkSession, root: str, orders: DataFrame) -> None:
    """Takes the orders that the states do not hold yet into them."""
    top = orders.agg(F.max("order_key")).first()[0] or 0
    for name, state in _states().items():
        path = f"{root}/state/{name}"
        chain = _chain(spark, path)
        end = chain[-1][1] if chain else 0
        if top > end:
            fresh = orders.where((F.col("order_key") > end) & (F.col("order_key") <= top))
            state.partial(fresh).write.mode("overwrite").parquet(f"{path}/{end:020d}-{top:020d}")
        if len(chain) >= COMPACT_AFTER:
            compact(spark, root, name)


def compact(spark: SparkSession, root: str, name: str) -> None:
    """One piece in place of the chain's; pieces off the chain go too."""
    path = f"{root}/state/{name}"
    chain = _chain(spark, path)
    if len(chain) > 1:
        whole = f"{0:020d}-{chain[-1][1]:020d}"
        read(spark, root, name).write.mode("overwrite").parquet(f"{path}/{whole}")
        for old in complete_folders(spark, path):
            if old != whole:
                remove(spark, f"{path}/{old}")


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The state over all its pieces, a row per key."""
    paths = [f"{root}/state/{name}/{piece}" for _, _, piece in _chain(spark, f"{root}/state/{name}")]
    return _states()[name].merged(spark.read.parquet(*paths))


def distinct_customers(visitors: DataFrame) -> DataFrame:
    """level, year, quarter, month, customers: the exact number of customers who
    ordered in every month, quarter and year."""
    out = None
    for level, span in (("month", ["year", "quarter", "month"]), ("quarter", ["year", "quarter"]), ("year", ["year"])):
        own = visitors.groupBy(*span, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        rows = own.groupBy(*span).agg(F.sum(F.bitmap_count("bitmap")).alias("customers")).select(
            F.lit(level).alias("level"), *(F.col(c) if c in span else F.lit(None).cast("int").alias(c) for c in ("year", "quarter", "month")), "customers")
        out = rows if out is None else out.unionByName(rows)
    return out


def monthly_revenue(spark: SparkSession, root: str) -> DataFrame:
    """BI1 from the states."""
    people = read(spark, root, "visitors").groupBy("year", "month").agg(F.sum(F.bitmap_count("bitmap")).alias("unique_customers"))
    return (read(spark, root, "months").join(people, ["year", "month"])
            .select("year", "month", "month_name", F.col("orders").alias("total_orders"), out_money(F.col("revenue")).alias("total_revenue"),
                    money_round(safe_div(F.col("revenue"), F.col("amounts")), 2).alias("avg_order_value"), "unique_customers")
            .orderBy("year", "month"))


def loyalty(spark: SparkSession, root: str) -> DataFrame:
    """BI2 from the states."""
    return business.loyalty_segments(read(spark, root, "customers").select(
        "customer_key", F.col("orders").alias("total_orders"), F.col("revenue").alias("total_spent"),
        safe_div(F.col("revenue"), F.col("amounts")).alias("avg_order_value")))


def acquisition(spark: SparkSession, root: str) -> DataFrame:
    """BI5 from the states."""
    return business.acquisition_totals(read(spark, root, "customers"))


# ------------------------------------------------------------------- the keys
def in_three_batches(wh: Warehouse) -> tuple[SparkSession, str]:
    """States of the warehouse's orders beside its tables, brought up by three updates
    whose orders overlap; once they are there nothing is left to add."""
    root = f"{wh.scratch}/states"
    top = wh.orders.agg(F.max("order_key")).first()[0] or 0
    for part in (top // 3, 2 * top // 3, top):
        update(wh.spark, root, wh.orders.where(F.col("order_key") <= part))
    return wh.spark, root


def customers_by_span(wh: Warehouse) -> DataFrame:
    spark, root = in_three_batches(wh)
    return distinct_customers(read(spark, root, "visitors"))
