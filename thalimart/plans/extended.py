"""Query keys beyond the source's own statements: its dialect as SQL text, and the
stored states, checks and loads of a warehouse that grows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.substring_match import first_like_match
from . import roundtrip, rules, states, statements
from .warehouse import Warehouse



def like_locations(wh: Warehouse) -> DataFrame:
    """city, location_key of restaurant cities that a location's city matches as a
    LIKE pattern; every vowel of the location is a wildcard, its digits too."""
    pattern = F.regexp_replace(F.regexp_replace("city", "[AEIOU]", "_"), "[0-9]", "%")
    return first_like_match(wh.dim_restaurant, "city", wh.dim_location.withColumn("city", pattern), "city", "location_key")


EXTENDED: dict[str, Callable[[Warehouse], DataFrame]] = {
    "sql_order_keys": statements.order_keys,
    "sql_julian_days": statements.julian_days,
    "sql_json_cuisines": statements.json_cuisines,
    "sql_recursive_cuisines": statements.recursive_cuisines,
    "state_distinct_customers": states.customers_by_span,
    "state_monthly_revenue": lambda wh: states.monthly_revenue(*states.in_three_batches(wh)),
    "state_loyalty": lambda wh: states.loyalty(*states.in_three_batches(wh)),
    "csv_users": roundtrip.users_through_csv,
    "csv_restaurants": roundtrip.restaurants_through_csv,
    "csv_locations": roundtrip.locations_through_csv,
    "dq_load_reasons": rules.reasons,
    "dq_quarantine": rules.rejected_orders,
    "like_location_match": like_locations,
    "state_acquisition": lambda wh: states.acquisition(*states.in_three_batches(wh)),
}
