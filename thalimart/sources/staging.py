"""Staging tables: schemas, CSV readers and the Staging bundle.

The four raw tables keep the source's column names on disk (including
``"Family size"``, ``"Monthly Income"``, ``"Educational qualifications"`` and
capitalised location columns) and are renamed to snake case on read. Every
cell is read as text, like the source's dynamically typed import; the ETL
applies the lenient casts. Blank cells read as NULL (the GUI import); pass
``blank_as_empty=True`` for the CLI import, where a blank becomes ``''``.

Each staged row carries ``ingest_seq``, the load order used by
insert-or-ignore ("first row wins"). For CSV it is (file path, split start,
row position in the split): a total order that follows the files' line
order and does not depend on how Spark packs splits into tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

USERS_CSV = ["user_id", "name", "email", "age", "gender", "Family size",
             "Monthly Income", "Educational qualifications"]
RESTAURANT_CSV = ["id", "name", "city", "rating", "cuisine"]
ORDERS_CSV = ["user_id", "r_id", "order_date", "sales_qty", "sales_amount", "currency"]
LOCATION_CSV = ["Country", "State", "City"]

RENAMES = {
    "Family size": "family_size",
    "Monthly Income": "monthly_income",
    "Educational qualifications": "education",
    "Country": "country",
    "State": "state",
    "City": "city",
}

USERS_COLS = ["user_id", "name", "email", "age", "gender", "family_size",
              "monthly_income", "education", "ingest_seq"]
RESTAURANT_COLS = ["id", "name", "city", "rating", "cuisine", "ingest_seq"]
ORDERS_COLS = ["user_id", "r_id", "order_date", "sales_qty", "sales_amount", "currency",
               "ingest_seq"]
LOCATION_COLS = ["country", "state", "city", "ingest_seq"]


@dataclass
class Staging:
    users: DataFrame
    restaurants: DataFrame
    orders: DataFrame
    locations: DataFrame
    #: The orders with their parsed cells, once they are written.
    parsed: DataFrame | None = None

    @property
    def order_cells(self) -> DataFrame:
        """The orders for a reader of parsed cells."""
        return self.orders if self.parsed is None else self.parsed


def _text_schema(cols: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in cols])


def read_csv_table(spark: SparkSession, path: str, cols: list[str],
                   blank_as_empty: bool = False) -> DataFrame:
    opts = {"header": "true", "mode": "PERMISSIVE"}
    df = spark.read.options(**opts).schema(_text_schema(cols)).csv(path)
    if blank_as_empty:
        # a CSV cell cannot tell NULL from blank; the CLI import stores ''
        df = df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in cols],
                       "_metadata")
    md = F.col("_metadata")
    seq = F.struct(md.getField("file_path").alias("file"),
                   md.getField("file_block_start").alias("block"),
                   F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row"))
    df = df.select("*", seq.alias("ingest_seq"))
    return df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in cols})


def read_csv_staging(spark: SparkSession, users: str, restaurants: str, orders: str,
                     locations: str, blank_as_empty: bool = False) -> Staging:
    return Staging(
        users=read_csv_table(spark, users, USERS_CSV, blank_as_empty).select(*USERS_COLS),
        restaurants=read_csv_table(spark, restaurants, RESTAURANT_CSV, blank_as_empty)
        .select(*RESTAURANT_COLS),
        orders=read_csv_table(spark, orders, ORDERS_CSV, blank_as_empty).select(*ORDERS_COLS),
        locations=read_csv_table(spark, locations, LOCATION_CSV, blank_as_empty)
        .select(*LOCATION_COLS),
    )
