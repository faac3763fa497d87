"""Staging -> star schema: four dimensions and the order fact.

Order of the source script is kept where it matters:

1. dimensions load first-row-wins on their natural keys, then get dense
   surrogate keys;
2. the fact keeps staged orders with a valid date, quantity and amount,
   deduplicates them on ``order_nk`` and resolves customer and restaurant
   keys with inner joins (unknown ids drop the order);
3. ``order_key`` is numbered over the loaded rows (before the delete, so
   deleted rows leave gaps, as an auto-numbered key does);
4. ``location_key`` comes from the restaurant's city (first matching
   location); USD amounts become INR (x 87), then amounts 0.0 and -1.0 are
   deleted - conversion first, so a USD -1 survives as -87.

The fact is stored *wide*: besides the nine fact columns it carries the
date, customer, restaurant and location attributes the analyses group by.
They are picked up by the joins that resolve the keys anyway, so every
later query reads one columnar table (with pruning) instead of shuffling
the fact again to join a large dimension. ``fact_order`` is a projection.

Divergences chosen (documented in README): an unparseable date produces no
``dim_date`` row (the source gains an auto-numbered junk row no order can
reference); keys are numbered in natural-key order (the source numbers in
load order); amounts are kept as DECIMAL(28,10) beside the rules, which look
at the uncut value: the natural key holds the cell's own text, and the delete
compares the REAL amount. An amount that DECIMAL(28,10) cannot hold (1e18 and
more, after conversion) is rejected and counted, see ``rejected_amounts``.

Every key assignment is one distributed numbering of narrow rows; attributes
are joined after it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import buckets as B
from ..functions.lenient import (date_text, iso_timestamp, lenient_double, lenient_int, ntz_text,
                                 raw_text, real_text, whole_text)
from ..functions.numeric import MONEY
from ..operators.dedup import first_per_key
from ..operators.substring_match import first_like_match, first_substring_match
from ..operators.surrogate import number_rows, with_dense_key
from ..session import written_under
from ..sources.staging import ORDERS_CSV, Staging

DIM_DATE_COLS = ["date_key", "date_iso", "year", "quarter", "month", "month_name", "day",
                 "dow", "is_weekend"]
DIM_CUSTOMER_COLS = ["customer_key", "user_id_nat", "name", "email", "age", "gender",
                     "family_size", "monthly_income_raw", "income_group", "income_group_order",
                     "education_raw", "education_group", "education_group_order"]
DIM_RESTAURANT_COLS = ["restaurant_key", "restaurant_id_nat", "name", "city", "rating",
                       "cuisine"]
DIM_LOCATION_COLS = ["location_key", "location_nk", "country", "state", "city"]
FACT_COLS = ["order_key", "order_nk", "date_key", "customer_key", "restaurant_key",
             "sales_qty", "sales_amount", "currency", "location_key"]


WIDE_SCHEMA = f"""order_key bigint, order_nk string, date_key int, customer_key bigint, restaurant_key bigint,
sales_qty bigint, sales_amount {MONEY}, currency string, location_key bigint, date_iso string, quarter int, month int,
month_name string, day int, dow int, is_weekend int, is_holiday int, income_group string, income_group_order int,
education_group string, education_group_order int, family_size int, restaurant_name string, restaurant_city string,
rating double, cuisine string, loc_country string, loc_state string, loc_city string, year int"""


def _dtype(df: DataFrame, name: str):
    return df.schema[name].dataType


def _numeric_then_text(nk: F.Column) -> list[F.Column]:
    """Total order for natural keys that are usually integers."""
    return [nk.try_cast("bigint").asc_nulls_last(), nk.asc_nulls_last()]


# ------------------------------------------------------------ parsed cells
PARSED_COLS = ["p_ts", "p_user", "p_rest", "p_qty", "p_qty_text", "p_amount", "p_amount_text"]


def parsed_orders(orders: DataFrame) -> DataFrame:
    """Staged orders with their parsed cells beside the raw ones: timestamp, ids
    and quantity as integers, the amount as REAL, and the texts that quantity and
    amount have in a natural key. ``stage`` writes them, so that every reader
    parses a cell no second time; an unwritten frame gets them here."""
    if "p_ts" in orders.columns:
        return orders
    qty, amount = _dtype(orders, "sales_qty"), _dtype(orders, "sales_amount")
    values = [iso_timestamp(F.col("order_date")), lenient_int(F.col("user_id"), _dtype(orders, "user_id")),
              lenient_int(F.col("r_id"), _dtype(orders, "r_id")), lenient_int(F.col("sales_qty"), qty),
              whole_text(F.col("sales_qty"), qty), lenient_double(F.col("sales_amount"), amount),
              real_text(F.col("sales_amount"), amount)]
    return orders.select("*", *(v.alias(c) for c, v in zip(PARSED_COLS, values, strict=True)))


def natural_key(user: F.Column, rest: F.Column) -> F.Column:
    """The six parts of ``order_nk``, from parsed cells; a NULL part is empty."""
    parts = [user, rest, ntz_text(F.col("p_ts")), F.trim(F.coalesce(F.col("currency"), F.lit(""))),
             F.col("p_qty_text"), F.col("p_amount_text")]
    return F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])


def key_cells() -> dict[str, F.Column]:
    """An order's natural key in four narrow cells, from parsed cells: user,
    restaurant, second, and the text of the other three parts. Ids and time hold no
    separator, so two orders have one ``order_nk`` exactly if these four are equal."""
    tail = [F.trim(F.coalesce(F.col("currency"), F.lit(""))), F.col("p_qty_text"), F.col("p_amount_text")]
    return {"p_user": F.col("p_user"), "p_rest": F.col("p_rest"),
            "p_ts": F.col("p_ts") - F.expr("make_dt_interval(0, 0, 0, extract(SECOND FROM p_ts) % 1)"),
            "p_tail": F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in tail])}


def whole_key() -> F.Column:
    """``order_nk`` from its four cells."""
    ids = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("p_user", "p_rest")]
    return F.concat_ws("|", *ids, F.coalesce(ntz_text(F.col("p_ts")), F.lit("")), F.col("p_tail"))


# ---------------------------------------------------------------- dim_date
def date_attributes(ts: F.Column) -> dict[str, F.Column]:
    d = F.to_date(ts)
    y, m, day = F.year(d), F.month(d), F.dayofmonth(d)
    dow = F.dayofweek(d)  # 1 = Sunday .. 7 = Saturday
    return {
        "date_key": (y * 10000 + m * 100 + day).cast("int"),
        "date_iso": date_text(d),
        "year": y.cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "month": m.cast("int"),
        "month_name": B.month_abbr(m),
        "day": day.cast("int"),
        "dow": dow.cast("int"),
        "is_weekend": F.when(dow.isin(1, 7), 1).otherwise(0),
    }


def build_dim_date(orders: DataFrame) -> DataFrame:
    """One row per distinct valid order date of *all* staged orders."""
    days = (parsed_orders(orders).select(F.to_date("p_ts").alias("d"))
            .where(F.col("d").isNotNull())
            .groupBy("d").agg(F.lit(1).alias("_one")))
    attrs = date_attributes(F.col("d"))
    return days.select(*[attrs[c].alias(c) for c in DIM_DATE_COLS])


# ------------------------------------------------------------ dim_customer
def customer_rows(users: DataFrame) -> DataFrame:
    """Customers without their key: the first staged row of every user id."""
    rows = users.select(
        raw_text(F.col("user_id")).alias("user_id_nat"),
        "name", "email",
        lenient_int(F.col("age"), _dtype(users, "age")).try_cast("int").alias("age"),
        "gender",
        lenient_int(F.col("family_size"), _dtype(users, "family_size")).try_cast("int").alias("family_size"),
        F.col("monthly_income").alias("monthly_income_raw"),
        F.col("education").alias("education_raw"),
        "ingest_seq",
    ).where(F.col("user_id_nat").isNotNull())
    first = first_per_key(rows, ["user_id_nat"], ["ingest_seq"]).drop("ingest_seq")
    inc = B.income_group(F.col("monthly_income_raw"))
    edu = B.education_group(F.col("education_raw"))
    return (first.withColumn("income_group", inc)
            .withColumn("income_group_order", B.income_group_order(F.col("income_group")))
            .withColumn("education_group", edu)
            .withColumn("education_group_order", B.education_group_order(F.col("education_group"))))


def key_customers(rows: DataFrame, scratch: str | None = None, after: int = 0) -> DataFrame:
    return with_dense_key(rows, _numeric_then_text(F.col("user_id_nat")), "customer_key",
                          scratch, after).select(*DIM_CUSTOMER_COLS)


def build_dim_customer(users: DataFrame, scratch: str | None = None) -> DataFrame:
    return key_customers(customer_rows(users), scratch)


# ---------------------------------------------------------- dim_restaurant
def restaurant_rows(restaurants: DataFrame) -> DataFrame:
    rows = restaurants.select(
        raw_text(F.col("id")).alias("restaurant_id_nat"),
        "name", "city",
        lenient_double(F.col("rating"), _dtype(restaurants, "rating")).alias("rating"),
        "cuisine", "ingest_seq",
    ).where(F.col("restaurant_id_nat").isNotNull())
    return first_per_key(rows, ["restaurant_id_nat"], ["ingest_seq"]).drop("ingest_seq")


def key_restaurants(rows: DataFrame, scratch: str | None = None, after: int = 0) -> DataFrame:
    return with_dense_key(rows, _numeric_then_text(F.col("restaurant_id_nat")), "restaurant_key",
                          scratch, after).select(*DIM_RESTAURANT_COLS)


def build_dim_restaurant(restaurants: DataFrame, scratch: str | None = None) -> DataFrame:
    return key_restaurants(restaurant_rows(restaurants), scratch)


# ------------------------------------------------------------ dim_location
def location_rows(locations: DataFrame) -> DataFrame:
    """Distinct (country, state, city); the key text prints a NULL state as ''
    so a NULL and an empty state collide - the NULL one (sorted first) wins."""
    rows = (locations.where(F.col("country").isNotNull() & F.col("city").isNotNull())
            .select("country", "state", "city")
            .withColumn("location_nk", F.concat_ws("|", F.col("country"),
                                                   F.coalesce(F.col("state"), F.lit("")),
                                                   F.col("city")))
            .withColumn("_state_rank", F.when(F.col("state").isNull(), 0).otherwise(1)))
    return first_per_key(rows.select("location_nk", "_state_rank", "country", "state", "city"),
                         ["location_nk"], ["_state_rank"]).drop("_state_rank")


def key_locations(rows: DataFrame, scratch: str | None = None, after: int = 0) -> DataFrame:
    order = [F.col("country").asc(), F.col("state").asc_nulls_first(), F.col("city").asc()]
    return with_dense_key(rows, order, "location_key", scratch, after).select(*DIM_LOCATION_COLS)


def build_dim_location(locations: DataFrame, scratch: str | None = None) -> DataFrame:
    return key_locations(location_rows(locations), scratch)


# ------------------------------------------------------- location matching
def restaurant_locations(dim_restaurant: DataFrame, dim_location: DataFrame, wildcards: bool = False) -> DataFrame:
    """``(restaurant_key, location_key)`` for restaurants whose city contains a
    location city (ASCII case folded); the smallest location key wins. The
    match runs on distinct restaurant cities, then joins back on the city.
    ``wildcards`` gives ``%`` and ``_`` in a location's city their LIKE meaning."""
    per_city = (first_like_match if wildcards else first_substring_match)(dim_restaurant, "city", dim_location, "city",
                                                                          "location_key")
    return (dim_restaurant.select("restaurant_key", "city")
            .join(per_city, "city").select("restaurant_key", "location_key"))


# -------------------------------------------------------------------- fact
def staged_fact_rows(orders: DataFrame) -> DataFrame:
    """Staged orders with the natural key and typed measures; rows that the
    fact cannot hold (no date, NULL quantity or amount, an amount beyond its
    type) are dropped here. ``amount`` is the uncut REAL value in INR: the
    currency is converted first, and the delete looks at the result."""
    valid = F.col("p_ts").isNotNull() & F.col("p_qty").isNotNull() & F.col("p_amount").isNotNull()
    return parsed_orders(orders).where(valid).select(*(c.alias(n) for n, c in fact_cells().items()), "ingest_seq")


def fact_cells(order_nk: F.Column | None = None) -> dict[str, F.Column]:
    """The fact's natural key, ids and typed measures, from parsed cells."""
    amount = F.col("p_amount")
    usd = B.is_usd(F.trim(F.col("currency")))
    exact = amount.try_cast(MONEY)
    converted = F.when(usd, F.try_multiply(exact, F.lit(B.USD_TO_INR).cast("decimal(10,0)"))).otherwise(exact)
    user, rest = F.col("p_user").cast("string"), F.col("p_rest").cast("string")
    return {
        "order_nk": natural_key(user, rest) if order_nk is None else order_nk,
        "date_key": date_attributes(F.col("p_ts"))["date_key"],
        "user_txt": user, "rest_txt": rest,
        "sales_qty": F.col("p_qty"),
        "amount": F.when(usd, amount * F.lit(float(B.USD_TO_INR))).otherwise(amount),
        "sales_amount": converted.try_cast(MONEY),
        "currency": F.when(usd, F.lit("INR")).otherwise(F.trim(F.col("currency"))),
    }


def fitting(rows: DataFrame) -> DataFrame:
    """Rows whose amount the fact's type holds."""
    return rows.where(F.col("sales_amount").isNotNull())


def rejected_amounts(orders: DataFrame) -> DataFrame:
    """How many staged orders (valid but for this) the fact's type cannot hold."""
    return staged_fact_rows(orders).agg(
        F.count(F.when(F.col("sales_amount").isNull(), 1)).alias("rejected_amounts"))


def restaurant_lookup(dim_restaurant: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Restaurant grain: restaurant key, attributes and the matched location
    (NULL when no location city matches)."""
    loc_of = restaurant_locations(dim_restaurant, dim_location)
    return (dim_restaurant.select(
        "restaurant_key", F.col("name").alias("restaurant_name"),
        F.col("city").alias("restaurant_city"), "rating", "cuisine")
        .join(loc_of, "restaurant_key", "left"))


def written_lookup(dim_restaurant: DataFrame, dim_location: DataFrame, scratch: str | None = None) -> DataFrame:
    """``restaurant_lookup`` from files, whose size tells Spark whether to broadcast
    it: a plan that learns it too late has shuffled the fact already."""
    lookup = restaurant_lookup(dim_restaurant, dim_location)
    return written_under(scratch, lookup, "restaurants") if scratch else lookup


def location_attributes(dim_location: DataFrame) -> DataFrame:
    return dim_location.select("location_key", F.col("country").alias("loc_country"),
                               F.col("state").alias("loc_state"), F.col("city").alias("loc_city"))


CUSTOMER_ATTRIBUTES = ["income_group", "income_group_order", "education_group", "education_group_order", "family_size"]


LOADED_COLS = ["order_nk", "date_key", "sales_qty", "amount", "sales_amount", "currency", "customer_key", *CUSTOMER_ATTRIBUTES,
               "restaurant_key"]
_CELL_ORDER = ["ingest_seq", "p_qty", "p_amount", "currency"]


def resolved_orders(orders: DataFrame, dim_customer: DataFrame, dim_restaurant: DataFrame) -> DataFrame:
    """Every staged order that the fact holds, copies too, with resolved keys, as
    narrow cells: the texts that a fact row derives from them come after the
    shuffles. The join that resolves the customer also picks up its attributes:
    customers grow with the orders, and a second join would shuffle the fact again."""
    valid = F.col("p_ts").isNotNull() & F.col("p_qty").isNotNull() & F.col("p_amount").isNotNull()
    rows = parsed_orders(orders).where(valid & fact_cells()["sales_amount"].isNotNull()).select(
        *(c.alias(n) for n, c in key_cells().items()), "p_qty", "p_amount", F.trim("currency").alias("currency"), "ingest_seq")
    cust = dim_customer.select("user_id_nat", "customer_key", *CUSTOMER_ATTRIBUTES)
    rest = dim_restaurant.select("restaurant_id_nat", "restaurant_key")
    return (rows.join(rest, F.col("p_rest").cast("string") == F.col("restaurant_id_nat"))
            .join(cust, F.col("p_user").cast("string") == F.col("user_id_nat")).drop("user_id_nat", "restaurant_id_nat"))


def with_fact_cells(cells: DataFrame) -> DataFrame:
    """``LOADED_COLS`` of resolved orders, after their other columns' (``order_key``)."""
    made = fact_cells(whole_key())
    known = [c for c in cells.columns if c == "order_key"]
    return cells.select(*known, *(made[c].alias(c) if c in made else c for c in LOADED_COLS))


def load_fact(orders: DataFrame, dim_customer: DataFrame, dim_restaurant: DataFrame) -> DataFrame:
    """Deduplicated staged orders with resolved keys, before numbering."""
    cells = resolved_orders(orders, dim_customer, dim_restaurant)
    return with_fact_cells(first_per_key(cells, list(key_cells()), _CELL_ORDER))


def number_orders(loaded: DataFrame, after: int = 0, scratch: str | None = None) -> DataFrame:
    """``order_key`` = ``after`` + dense rank in ``order_nk`` order."""
    return with_dense_key(loaded, [F.col("order_nk").asc()], "order_key", scratch, after)


def number_first_orders(cells: DataFrame, after: int = 0, scratch: str | None = None) -> DataFrame:
    """The first staged row of every natural key of resolved orders, numbered like
    ``number_orders``. One shuffle does both: rows are dealt by ranges of the key, so
    its copies meet in one task, which reads them in order and keeps the first."""
    ranges = cells.repartitionByRange(whole_key()).withColumn("order_nk", whole_key())
    place = F.row_number().over(Window.partitionBy("order_nk").orderBy(*_CELL_ORDER))
    first = ranges.withColumn("_place", place).where("_place = 1").drop("_place", "order_nk", "ingest_seq")
    return with_fact_cells(number_rows(first, "order_key", scratch, after))


def finish_fact(keyed: DataFrame, lookup: DataFrame, dim_location: DataFrame, ordered: bool = False) -> DataFrame:
    """The invalid-amount delete on the uncut amount, then the wide layout (fact
    columns + date/customer/restaurant/location attributes). ``ordered`` sorts each
    task's rows by date while they are narrow: the joins keep that order."""
    y = (F.col("date_key") / 10000).cast("int")
    md = F.col("date_key") % 10000
    month = (md / 100).cast("int")
    kept = keyed.where(~F.col("amount").isin(*map(float, B.INVALID_AMOUNTS))).withColumns({"year": y, "month": month})
    if ordered:
        kept = kept.sortWithinPartitions("year", "month", "date_key")
    wide = (kept.join(lookup, "restaurant_key")
            .join(location_attributes(dim_location), "location_key", "left"))
    y, month = F.col("year"), F.col("month")
    day = (md % 100).cast("int")
    a = date_attributes(F.make_date(y, month, day))
    return wide.select(
        *FACT_COLS,
        a["date_iso"].alias("date_iso"), a["quarter"].alias("quarter"),
        "month", a["month_name"].alias("month_name"),
        day.alias("day"), a["dow"].alias("dow"), a["is_weekend"].alias("is_weekend"),
        B.is_holiday(month, day).alias("is_holiday"),
        *CUSTOMER_ATTRIBUTES, "restaurant_name", "restaurant_city", "rating", "cuisine",
        "loc_country", "loc_state", "loc_city", "year")


def build_fact_wide(orders: DataFrame, dim_customer: DataFrame, dim_restaurant: DataFrame,
                    dim_location: DataFrame, scratch: str | None = None) -> DataFrame:
    keyed = number_first_orders(resolved_orders(orders, dim_customer, dim_restaurant), scratch=scratch)
    return finish_fact(keyed, written_lookup(dim_restaurant, dim_location, scratch), dim_location, ordered=True)


# ------------------------------------------------- the source script's views
def orders_with_raw_key(orders: DataFrame) -> DataFrame:
    """``v_stg_orders_nk``: every staged order with a key whose ids are the raw
    cell texts (the fact's own key normalises them to integers)."""
    nk = natural_key(F.trim(raw_text(F.col("user_id"))), F.trim(raw_text(F.col("r_id"))))
    return parsed_orders(orders).select(nk.alias("order_nk"), *ORDERS_CSV)


def fact_load_rows(orders: DataFrame, dim_customer: DataFrame, dim_restaurant: DataFrame) -> DataFrame:
    """``v_fact_load``: staged orders with resolved keys, before the insert
    removes repeated natural keys; amounts as staged (not yet converted)."""
    user, rest = F.col("p_user").cast("string"), F.col("p_rest").cast("string")
    staged = parsed_orders(orders).where(F.col("p_ts").isNotNull()).select(
        natural_key(user, rest).alias("order_nk"),
        date_attributes(F.col("p_ts"))["date_key"].alias("date_key"),
        user.alias("user_id_nat"), rest.alias("restaurant_id_nat"), F.col("p_qty").alias("sales_qty"),
        F.col("p_amount").alias("sales_amount"), F.trim(F.col("currency")).alias("currency"))
    return (staged.join(dim_customer.select("user_id_nat", "customer_key"), "user_id_nat")
            .join(dim_restaurant.select("restaurant_id_nat", "restaurant_key"), "restaurant_id_nat")
            .select("order_nk", "date_key", "customer_key", "restaurant_key", "sales_qty", "sales_amount", "currency"))


@dataclass
class StarFrames:
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_restaurant: DataFrame
    dim_location: DataFrame


def build_dimensions(staging: Staging) -> StarFrames:
    return StarFrames(
        dim_date=build_dim_date(staging.orders),
        dim_customer=build_dim_customer(staging.users),
        dim_restaurant=build_dim_restaurant(staging.restaurants),
        dim_location=build_dim_location(staging.locations),
    )
