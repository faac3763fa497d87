"""The staging tables written as CSV and read back through the staging readers:
what an import keeps, as summary rows. Orders go through the plain reader; users,
restaurants and locations through the checked one, with their columns in reverse
order, a surplus cell on some lines and a missing one on others."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lenient import lenient_double, lenient_int
from ..functions.numeric import wide_sum
from ..sources.checked_csv import BAD_LINE, cells_of, read_checked_csv
from ..sources.staging import LOCATION_CSV, ORDERS_CSV, RENAMES, RESTAURANT_CSV, USERS_CSV, read_csv_table
from .warehouse import Warehouse


def staging_through_csv(wh: Warehouse) -> DataFrame:
    """currency, n_rows, n_users, qty, bad_dates, amount of the re-read orders."""
    spark = wh.staging.orders.sparkSession
    path = f"{wh.scratch}/csv-{uuid.uuid4().hex}"
    # the source's cells are text; a cell with surrounding spaces is quoted
    wh.staging.orders.select(*ORDERS_CSV).write.option("header", "true").option("quoteAll", "true") \
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    back = read_csv_table(spark, path, ORDERS_CSV)
    amount = lenient_double(F.col("sales_amount")).cast("decimal(38,5)")
    return back.groupBy("currency").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("user_id").alias("n_users"),
        F.sum(lenient_int(F.col("sales_qty"))).cast("bigint").alias("qty"),
        F.count(F.when(F.col("order_date") == "bad-date", 1)).alias("bad_dates"),
        wide_sum(amount).alias("amount"))


def _through_faulty_csv(wh: Warehouse, table: DataFrame, cols: list[str], surplus: Column, short: Column) -> DataFrame:
    """``table`` as lines of quoted cells, the header reversed, and read again.
    ``surplus`` lines get a cell more, ``short`` ones lose the last."""
    spark = table.sparkSession
    path = f"{wh.scratch}/faulty-{uuid.uuid4().hex}"
    cells = [F.col(RENAMES.get(c, c)).cast("string") for c in reversed(cols)]
    quoted = [F.coalesce(F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")) for c in cells]
    line = F.concat(F.concat_ws(",", *quoted[:-1]), F.when(short, F.lit("")).otherwise(F.concat(F.lit(","), quoted[-1])),
                    F.when(surplus, F.lit(",surplus")).otherwise(F.lit("")))
    # one column named like the header line; nothing in it is special to this writer
    (table.select(line.alias(",".join(reversed(cols)))).write.option("header", "true").option("sep", "\u0001").option("quote", "\u0002")
     .option("escape", "\u0003").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    return read_checked_csv(spark, path, cols)


def _summary(rows: DataFrame, width: int, group: Column, **measures: Column) -> DataFrame:
    cells = cells_of(F.col(BAD_LINE))
    return rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(cells > width, 1)).alias("surplus_lines"), F.count(F.when(cells < width, 1)).alias("short_lines"),
        *(m.alias(name) for name, m in measures.items()))


def users_through_csv(wh: Warehouse) -> DataFrame:
    """S1: monthly_income, n_rows, faulty lines, n_ids, ages of the re-read users;
    the id is the last cell of a line, so short lines have none."""
    key = F.col("user_id") % 10
    rows = _through_faulty_csv(wh, wh.staging.users, USERS_CSV, key == 3, key == 7)
    return _summary(rows, len(USERS_CSV), F.col("monthly_income"), n_ids=F.count_distinct("user_id"), ages=F.sum(lenient_int(F.col("age"))).cast("bigint"))


def restaurants_through_csv(wh: Warehouse) -> DataFrame:
    """S2: cuisine, n_rows, faulty lines, n_ids, ratings of the re-read restaurants."""
    key = F.col("id") % 10
    rows = _through_faulty_csv(wh, wh.staging.restaurants, RESTAURANT_CSV, key == 3, key == 7)
    return _summary(rows, len(RESTAURANT_CSV), F.col("cuisine"), n_ids=F.count_distinct("id"),
                    ratings=F.sum(lenient_double(F.col("rating")).cast("decimal(38,5)")).cast("double"))


def locations_through_csv(wh: Warehouse) -> DataFrame:
    """S4: state, n_rows, faulty lines, n_countries, cities of the re-read locations;
    the country is the last cell of a line."""
    name = F.col("city")
    rows = _through_faulty_csv(wh, wh.staging.locations, LOCATION_CSV, name.endswith("3"), name.endswith("7"))
    return _summary(rows, len(LOCATION_CSV), F.col("state"), n_countries=F.count("country"), cities=F.count_distinct("city"))
