"""Incremental loads: insert-or-ignore of a later batch into a written warehouse.

Dimensions: rows whose natural key is new get keys after the largest one.
Facts: the batch is deduplicated on ``order_nk`` and its keys resolved; what the
fact already holds is ignored; the rest gets keys after the largest one and the
conversion and delete rules. A natural key contains the order's second, so only
existing rows of the batch's own years and days can hold it: the existing fact
is filtered by literals taken from the batch (one bounded aggregate), which
prunes year folders and row groups before the anti join.
Locations: restaurants that had no location are matched again when locations
arrive; facts that have one keep it.

Orders that the fact cannot take go to a quarantine table (``plans.rules``); those
whose user or restaurant is not known yet are tried again with every later batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import etl
from .warehouse import Warehouse, written_under

# Boundaries used by the ``etl_fact_incremental`` check: staged orders dated
# before the first text form the first load; the second load holds those dated
# from the second text on and the bad dates, so the batches overlap.
FIRST_BEFORE, LATER_FROM = "2018-07-01", "2018-01-01"


def new_rows(rows: DataFrame, dimension: DataFrame, natural_key: str) -> DataFrame:
    """Rows whose natural key the dimension does not hold."""
    return rows.join(dimension.select(natural_key), natural_key, "left_anti").select(*rows.columns)


def largest(df: DataFrame, key: str) -> int:
    return int(df.agg(F.max(key).alias("m")).first()["m"] or 0)


def dimension_additions(wh: Warehouse, staging, scratch: str) -> dict[str, DataFrame]:
    """The rows a later staging batch adds to each dimension."""
    loc = new_rows(etl.location_rows(staging.locations), wh.dim_location, "location_nk")
    cust = new_rows(etl.customer_rows(staging.users), wh.dim_customer, "user_id_nat")
    rest = new_rows(etl.restaurant_rows(staging.restaurants), wh.dim_restaurant, "restaurant_id_nat")
    return {
        "dim_date": new_rows(etl.build_dim_date(staging.order_cells), wh.dim_date, "date_key"),
        "dim_customer": etl.key_customers(cust, scratch, largest(wh.dim_customer, "customer_key")),
        "dim_restaurant": etl.key_restaurants(rest, scratch, largest(wh.dim_restaurant, "restaurant_key")),
        "dim_location": etl.key_locations(loc, scratch, largest(wh.dim_location, "location_key")),
    }


def existing_keys(existing: DataFrame, loaded: DataFrame) -> DataFrame:
    """order_nk of the existing facts that may repeat in ``loaded``: the scan is
    limited by literals to the batch's years and its range of days."""
    year = (F.col("date_key") / 10000).cast("int")
    span = loaded.agg(F.min("date_key").alias("a"), F.max("date_key").alias("b"), F.collect_set(year).alias("years")).first()
    if span.a is None:
        return existing.where(F.lit(False)).select("order_nk")
    return existing.where(F.col("year").isin(span.years) & F.col("date_key").between(span.a, span.b)).select("order_nk")


def append_batch(existing: DataFrame, batch_orders: DataFrame, wh: Warehouse, scratch: str,
                 top: int | None = None) -> DataFrame:
    """Wide fact rows that ``batch_orders`` adds to ``existing``; new keys start
    after ``top`` (default: the largest key in ``existing``)."""
    cells = written_under(scratch, etl.resolved_orders(batch_orders, wh.dim_customer, wh.dim_restaurant), "batch")
    known = existing_keys(existing, etl.with_fact_cells(cells))
    fresh = cells.join(known, etl.whole_key() == F.col("order_nk"), "left_anti")  # the key's text itself is not shuffled
    top = largest(existing, "order_key") if top is None else top
    return _finished(etl.number_first_orders(fresh, int(top), scratch), wh, scratch)


def append_loaded(existing: DataFrame, loaded: DataFrame, wh: Warehouse, scratch: str, top: int | None = None) -> DataFrame:
    """``append_batch`` for orders whose keys are resolved and written."""
    fresh = loaded.join(existing_keys(existing, loaded), "order_nk", "left_anti")
    top = largest(existing, "order_key") if top is None else top
    return _finished(etl.number_orders(fresh, int(top), scratch), wh, scratch)


def _finished(keyed: DataFrame, wh: Warehouse, scratch: str) -> DataFrame:
    return etl.finish_fact(keyed, etl.written_lookup(wh.dim_restaurant, wh.dim_location, scratch), wh.dim_location)


def fact_in_two_batches(wh: Warehouse) -> DataFrame:
    """Fact built as an initial load plus one later, overlapping batch."""
    orders = wh.staging.order_cells
    date = F.col("order_date")
    first = orders.where(date < FIRST_BEFORE)
    later = orders.where((date >= LATER_FROM) | date.isNull())
    initial = written_under(wh.scratch, etl.build_fact_wide(first, wh.dim_customer, wh.dim_restaurant,
                                                            wh.dim_location, wh.scratch), "first-load", "year")
    return initial.unionByName(append_batch(initial, later, wh, wh.scratch))


def customers_in_two_batches(wh: Warehouse) -> DataFrame:
    """``dim_customer`` from the users with odd ids, then all users: known ids
    are ignored, new ones get keys after the largest."""
    users = wh.staging.users
    odd = F.col("user_id") % 2 == 1
    first = written_under(wh.scratch, etl.build_dim_customer(users.where(odd), wh.scratch), "customers")
    fresh = new_rows(etl.customer_rows(users), first, "user_id_nat")
    return first.unionByName(etl.key_customers(fresh, wh.scratch, largest(first, "customer_key")))


def patch_locations(fact: DataFrame, dim_restaurant: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Fact rows without a location get the one their restaurant's city matches
    now; the others keep theirs. (fact needs restaurant_key and location_key.)"""
    found = etl.restaurant_locations(dim_restaurant, dim_location).withColumnRenamed("location_key", "_found")
    return (fact.join(found, "restaurant_key", "left")
            .withColumn("location_key", F.coalesce("location_key", "_found")).drop("_found").select(*fact.columns))


def locations_in_two_batches(wh: Warehouse) -> DataFrame:
    """order_key, location_key when the locations without a state come first and
    all locations later."""
    locations = wh.staging.locations
    first = written_under(wh.scratch, etl.build_dim_location(locations.where(F.col("state").isNull()), wh.scratch), "locations")
    added = etl.key_locations(new_rows(etl.location_rows(locations), first, "location_nk"), wh.scratch,
                              largest(first, "location_key"))
    whole = written_under(wh.scratch, first.unionByName(added), "all-locations")
    bare = wh.fact.select("order_key", "restaurant_key", F.lit(None).cast("bigint").alias("location_key"))
    before = patch_locations(bare, wh.dim_restaurant, first)
    return patch_locations(before, wh.dim_restaurant, whole).select("order_key", "location_key")
