"""Adapter: fill the four staging tables from the TPC-H-like test tables.

The test tables carry no food-delivery data, so each staging column is a
fixed expression over one base table (the SQL oracle applies the same
expressions). Every base row is used; rules only set values:

* users <- customer (+ one 'DUP' copy of every 50th customer, loaded later,
  so "first row wins" is exercised), + a guest user per 16th order and an
  inactive user per 4th customer, both with ids above 2^31;
* restaurants <- supplier x nation (names repeat, some cities match no
  location, cuisines cover every splitter case);
* locations <- nation x region (NULL states, the first five nations twice,
  NATION_1 is a substring of NATION_10..19 so city matching is ambiguous);
* orders <- lineitem x orders, with bad dates, amounts of 0, -1, 0.00004,
  10.00001 beside 10.00002, 1e15 and (beyond the fact's type) 1e30, USD in
  three spellings and natural-key duplicate copies. The lines of every 16th
  order belong to its guest user, which makes customers with one or few
  orders; the lines of every 31st customer name users that do not exist
  (about 3%), which the unknown-user rule drops. No staged row is filtered
  out here.

Order dates move forward 6,940 days (1995-2001 -> 2014-2020) plus
``l_orderkey % 24`` hours, as ISO text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lenient import ntz_text
from .staging import LOCATION_COLS, ORDERS_COLS, RESTAURANT_COLS, USERS_COLS, Staging

DATE_SHIFT_DAYS = 6940
GUEST_IDS = 3_000_000_000       # + o_orderkey
INACTIVE_IDS = 6_000_000_000    # + c_custkey


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _copies(cond) -> F.Column:
    """Row multiplier: seq 0 always, seq 1 as a later duplicate when ``cond``."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    return F.explode(F.when(cond, F.array(zero, one)).otherwise(F.array(zero)))


def stg_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    bal = F.col("c_acctbal")
    income = (F.when(k % 23 == 0, F.lit(None).cast("string"))
              .when(bal < 1000, "No Income")
              .when(bal < 3000, "Below Rs.10000")
              .when(bal < 5000, "10001 to 25000")
              .when(bal < 7500, "25001 to 50000")
              .otherwise("More than 50000"))
    seg = F.col("c_mktsegment")
    education = (F.when(k % 29 == 0, "ph.d")
                 .when(seg == "AUTOMOBILE", "Graduate")
                 .when(seg == "BUILDING", "Post Graduate")
                 .when(seg == "FURNITURE", "School")
                 .when(seg == "HOUSEHOLD", "Ph.D")
                 .when(seg == "MACHINERY", "Uneducated"))
    rows = c.select(
        k.alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        (F.lit(18) + k % 50).cast("int").alias("age"),
        F.when(k % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(F.lit(1) + k % 6).cast("int").alias("family_size"),
        income.alias("monthly_income"),
        education.alias("education"),
        _copies(k % 50 == 0).alias("ingest_seq"))
    rows = rows.withColumn("name", F.when(F.col("ingest_seq") == 1, "DUP").otherwise(F.col("name")))

    def extra(df: DataFrame, key: F.Column, base: int, name: str) -> DataFrame:
        return df.select((key + base).alias("user_id"), F.lit(name).alias("name"), F.lit(None).cast("string").alias("email"),
                         F.lit(40).alias("age"), F.lit(None).cast("string").alias("gender"),
                         (key % 5).cast("int").alias("family_size"), F.lit("More than 50000").alias("monthly_income"),
                         F.lit("School").alias("education"), F.lit(0).cast("long").alias("ingest_seq"))

    ok = F.col("o_orderkey")
    guests = extra(_read(spark, sf_dir, "orders").where(ok % 16 == 0), ok, GUEST_IDS, "Guest")
    inactive = extra(c.where(k % 4 == 0), k, INACTIVE_IDS, "Inactive")
    return rows.select(*USERS_COLS).unionByName(guests).unionByName(inactive)


def stg_restaurant(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("s_suppkey")
    city = (F.when(k % 19 == 0, "Nowhere")
            .otherwise(F.concat(F.lit("Area "), (k % 7).cast("string"), F.lit(","),
                                F.lower("n_name"))))
    m = k % 8
    cuisine = (F.when(m == 0, "North Indian,Chinese").when(m == 1, "Chinese")
               .when(m == 2, " Biryani , Indian").when(m == 3, "Snacks,")
               .when(m == 4, "Indian,,Snacks").when(m == 5, F.lit(None).cast("string"))
               .when(m == 6, "Chinese,Chinese").otherwise(""))
    rating = F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise((k % 51).cast("double") / 10.0)
    return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
            .select(k.alias("id"),
                    F.concat(F.lit("Kitchen "), (k % 40).cast("string")).alias("name"),
                    city.alias("city"), rating.alias("rating"), cuisine.alias("cuisine"),
                    F.lit(0).cast("long").alias("ingest_seq"))
            .select(*RESTAURANT_COLS))


def stg_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation")
    r = _read(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    state = F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("State "), (k % 5).cast("string")))
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
            .select(F.col("r_name").alias("country"), state.alias("state"),
                    F.col("n_name").alias("city"), _copies(k < 5).alias("ingest_seq"))
            .select(*LOCATION_COLS))


def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
        "l_linenumber")
    od = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # fact-to-fact join: a shuffle join (both sides grow with the data); the
    # hint keeps it one even where orders would fit a broadcast, so the
    # per-row work after it is spread over the shuffle partitions
    j = li.join(od.hint("merge"), li.l_orderkey == od.o_orderkey)
    ok = F.col("l_orderkey")
    ck = F.col("o_custkey")
    ts = F.col("o_orderdate") + F.make_dt_interval(F.lit(DATE_SHIFT_DAYS), (ok % 24).cast("int"))
    order_date = F.when(ok % 101 == 0, "bad-date").otherwise(ntz_text(ts))
    first_line = F.col("l_linenumber") == 1
    amount = (F.when(ok % 97 == 0, F.lit(0.0)).when(ok % 89 == 0, F.lit(-1.0))
              .when(ok % 83 == 0, F.lit(0.00004))
              .when((ok % 79 == 0) & (F.col("ingest_seq") == 0), F.lit(10.00001))
              .when(ok % 79 == 0, F.lit(10.00002))
              .when((ok % 997 == 0) & first_line, F.lit(1e15)).when((ok % 991 == 0) & first_line, F.lit(1e30))
              .otherwise(F.col("l_extendedprice")))
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    currency = (F.when(flag == "A", " USD ").when(flag == "N", "INR")
                .when((flag == "R") & (status == "F"), "usd"))
    twice = ((ck % 50 == 0) & (F.col("l_suppkey") % 10 == 3)) | (ok % 79 == 0)
    return j.withColumn("ingest_seq", _copies(twice)).select(
        F.when(ck % 31 == 0, -(ck + 1)).when(ok % 16 == 0, ok + GUEST_IDS).otherwise(ck).alias("user_id"),
        F.col("l_suppkey").alias("r_id"),
        order_date.alias("order_date"),
        F.col("l_quantity").cast("int").alias("sales_qty"),
        amount.alias("sales_amount"),
        currency.alias("currency"), "ingest_seq",
    ).select(*ORDERS_COLS)


def adapter_staging(spark: SparkSession, sf_dir: str) -> Staging:
    return Staging(users=stg_users(spark, sf_dir), restaurants=stg_restaurant(spark, sf_dir),
                   orders=stg_orders(spark, sf_dir), locations=stg_location(spark, sf_dir))
