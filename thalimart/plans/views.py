"""SQL access: the written warehouse as temporary views.

The staging tables, the star schema, the analysis view and the three views of the source's load
script: staged orders with their raw-text key, calendar rows of order dates the
calendar lacks, and staged orders resolved to surrogate keys. All are lazy
projections of the written Parquet tables.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sql_functions import register_functions
from . import etl
from .family import family_view
from .warehouse import Warehouse


def stg_orders_nk(wh: Warehouse) -> DataFrame:
    return etl.orders_with_raw_key(wh.staging.order_cells)


def new_dates(wh: Warehouse) -> DataFrame:
    """Calendar rows of all staged order dates (the load ignores known ones)."""
    return etl.build_dim_date(wh.staging.order_cells)


def fact_load(wh: Warehouse) -> DataFrame:
    return etl.fact_load_rows(wh.staging.order_cells, wh.dim_customer, wh.dim_restaurant)


VIEWS = {
    "fact_order": lambda wh: wh.fact.withColumn("sales_amount", F.col("sales_amount").cast("double")),
    "dim_date": lambda wh: wh.dim_date,
    "dim_customer": lambda wh: wh.dim_customer,
    "dim_restaurant": lambda wh: wh.dim_restaurant,
    "dim_location": lambda wh: wh.dim_location,
    "v_family_analysis": family_view,
    "v_stg_orders_nk": stg_orders_nk,
    "v_new_dates": new_dates,
    "v_fact_load": fact_load,
    "stg_users": lambda wh: wh.staging.users,
    "stg_restaurant": lambda wh: wh.staging.restaurants,
    "stg_orders": lambda wh: wh.staging.orders,
    "stg_location": lambda wh: wh.staging.locations,
}


def register_views(spark: SparkSession, wh: Warehouse, names: Iterable[str] = VIEWS) -> tuple[str, ...]:
    """Creates the views, and the source dialect's functions, in the session."""
    register_functions(spark)
    for name in names:
        VIEWS[name](wh).createOrReplaceTempView(name)
    return tuple(names)

