"""Rules of the fact, enforced where it is written.

One pass over staged orders decides every row: each gets the first reason for which
the fact cannot take it, or none. The rows are written once, partitioned by reason,
so accepted orders and the quarantine come from the same job, and the counts come
from that job's metrics (``observe``): nothing is scanned a second time to count.

Reasons, in the order in which they are tried:

* ``bad_date``, ``no_quantity``, ``no_amount``: a cell that the fact needs is missing
  or cannot be read;
* ``amount_too_large``: the amount in INR is beyond the fact's type;
* ``unknown_user``, ``unknown_restaurant``: no dimension row has the id (yet); these
  orders wait and are tried again with the next batch;
* ``deleted_amount``: an amount of 0 or -1 after conversion.

Repeated natural keys are one row with the number of its ``copies``, the first
staged one; copies beyond it are counted as ``duplicate``. Rows that fail on a cell
have no natural key and are kept one by one: they pass the same aggregate under a
key of their own, so the staging is read once and a hot natural key collapses in
every map task. Accepted orders are written without their raw cells, the others with
nothing else.

The quarantine keeps the raw cells, so a corrected rule or a late dimension row can
load them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import buckets as B
from ..functions.numeric import MONEY
from ..sources.staging import ORDERS_CSV
from . import etl
from .warehouse import Warehouse

ACCEPTED, DUPLICATE = "accepted", "duplicate"
REASONS = ("bad_date", "no_quantity", "no_amount", "amount_too_large", "unknown_user", "unknown_restaurant", "deleted_amount")
WAITING = ("unknown_user", "unknown_restaurant")

_RAW = {c: f"raw_{c}" for c in ORDERS_CSV}
_SCHEMA = (
    f"copies bigint, order_nk string, date_key int, user_txt string, rest_txt string, sales_qty bigint, amount double, sales_amount {MONEY}, "
    f"currency string, {', '.join(f'{r} string' for r in _RAW.values())}, customer_key bigint, income_group string, income_group_order int, "
    "education_group string, education_group_order int, family_size int, restaurant_key bigint, reason string")


def decided(orders: DataFrame, dim_customer: DataFrame, dim_restaurant: DataFrame) -> DataFrame:
    """Every natural key of the staged orders, and every row without one, with its
    ``copies`` and ``reason``: accepted ones as the fact's cells and keys, the others
    as raw cells. Rows are narrow cells until they are decided; what a reader of
    either kind does not need is NULL."""
    broken = (F.when(F.col("p_ts").isNull(), REASONS[0]).when(F.col("p_qty").isNull(), REASONS[1])
              .when(F.col("p_amount").isNull(), REASONS[2]).when(etl.fact_cells()["sales_amount"].isNull(), REASONS[3]))
    own = F.col("reason").isNotNull()
    keys = etl.key_cells() | {"row": F.monotonically_increasing_id()}
    measures = ["p_qty", "p_amount", "trimmed"]
    rows = etl.parsed_orders(orders).select("*", broken.alias("reason"), F.trim("currency").alias("trimmed")).select(
        *(F.when(own if n == "row" else ~own, c).alias(n) for n, c in keys.items()), "ingest_seq", *measures,
        *(F.col(c).alias(r) for c, r in _RAW.items()), "reason")
    kept = [*measures, *_RAW.values(), "reason"]
    first = rows.groupBy(*keys).agg(F.min(F.struct("ingest_seq", *kept)).alias("m"), F.count(F.lit(1)).alias("copies"))
    one = first.select(*keys, "copies", *(F.col(f"m.{c}").alias("currency" if c == "trimmed" else c) for c in kept))
    # what has no id, or needs none, is spread over the joins by its own key
    alone = F.concat(F.lit("\u0001"), F.xxhash64(*keys).cast("string"))
    user, rest = (F.when(F.col("reason").isNull(), F.coalesce(F.col(c).cast("string"), alone)).otherwise(alone) for c in ("p_user", "p_rest"))
    customer = dim_customer.select(F.col("user_id_nat").alias("user_nat"), "customer_key", *etl.CUSTOMER_ATTRIBUTES)
    restaurant = dim_restaurant.select(F.col("restaurant_id_nat").alias("rest_nat"), "restaurant_key")
    met = (one.join(restaurant, rest == F.col("rest_nat"), "left")
           .join(customer, user == F.col("user_nat"), "left"))
    made = etl.fact_cells(etl.whole_key())
    reason = F.coalesce(F.col("reason"), F.when(F.col("customer_key").isNull(), REASONS[4]).when(F.col("restaurant_key").isNull(), REASONS[5])
                        .when(made["amount"].isin(*map(float, B.INVALID_AMOUNTS)), REASONS[6]), F.lit(ACCEPTED))
    taken = F.col("reason") == ACCEPTED
    out = {c: F.when(~taken, F.col(c).cast("string")) if c in _RAW.values() else F.col(c) if c in ("copies", "reason") else F.when(taken, made.get(c, F.col(c)))
           for c in (x.split()[0] for x in _SCHEMA.split(", "))}
    return met.withColumn("reason", reason).select(*(c.alias(n) for n, c in out.items()))


def checked_load(orders: DataFrame, wh: Warehouse, path: str) -> dict[str, int]:
    """Decides the staged orders and writes them under ``path`` by reason; the
    number of orders per reason, of accepted ones and of duplicates."""
    counted = Observation("load")
    per_reason = [F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in (*REASONS, ACCEPTED)]
    rows = decided(orders, wh.dim_customer, wh.dim_restaurant).observe(
        counted, *per_reason, F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias(DUPLICATE))
    rows.write.partitionBy("reason").parquet(path)
    return {name: int(n) for name, n in counted.get.items()}


def accepted(spark: SparkSession, path: str) -> DataFrame:
    """The orders that the fact takes, as ``etl.load_fact`` gives them."""
    return spark.read.schema(_SCHEMA).parquet(path).where(F.col("reason") == ACCEPTED).select(
        "order_nk", "date_key", "sales_qty", "amount", "sales_amount", "currency", "customer_key", *etl.CUSTOMER_ATTRIBUTES, "restaurant_key")


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """reason, copies and the raw cells of the orders that the fact does not take."""
    return spark.read.schema(_SCHEMA).parquet(path).where(F.col("reason") != ACCEPTED).select(
        "reason", "copies", *(F.col(r).alias(c) for c, r in _RAW.items()))


def waiting(rejected: DataFrame) -> DataFrame:
    """The raw cells of orders that may be loaded once their dimension row comes."""
    return rejected.where(F.col("reason").isin(*WAITING)).select(*ORDERS_CSV)


# ------------------------------------------------------------------- the keys
def _fresh(wh: Warehouse) -> str:
    return f"{wh.scratch}/load-{uuid.uuid4().hex}"


def reasons(wh: Warehouse) -> DataFrame:
    """reason, orders: what a load of all staged orders would accept and reject."""
    return wh.spark.createDataFrame(list(checked_load(wh.staging.order_cells, wh, _fresh(wh)).items()), "reason string, orders bigint")


def rejected_orders(wh: Warehouse) -> DataFrame:
    """reason, currency, orders, copies of the quarantine of such a load."""
    path = _fresh(wh)
    checked_load(wh.staging.order_cells, wh, path)
    return quarantine(wh.spark, path).groupBy("reason", "currency").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("copies").alias("copies"))
