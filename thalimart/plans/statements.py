"""Statements in the source's dialect, run as SQL text over the registered views.

They use what the function layer (``functions.sql_functions``) adds to Spark SQL:
``strftime``, ``printf_text``, ``julianday`` and ``datetime`` on raw order cells,
``json_each`` as a lateral table function, and a recursive splitter. Spark inlines
the functions, so the plans hold neither Python nor a join of all pairs. Orders
are counted per cuisine text before it is split; the recursion runs over the
distinct texts of the restaurants.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from .views import VIEWS, register_views
from .warehouse import Warehouse

ORDER_KEYS = """
SELECT strftime('%Y%m', order_date) AS month, printf_text('%s|%s', IFNULL(TRIM(currency), ''), strftime('%w', order_date)) AS label,
  COUNT(*) AS orders, MIN(strftime('%Y-%m-%d %H:%M:%S', order_date)) AS first_at,
  MAX(printf_text('%08d/%s', CAST(r_id AS STRING), strftime('%j', order_date))) AS last_key
FROM stg_orders GROUP BY ALL"""

JULIAN_DAYS = """
SELECT strftime('%Y-%m', CAST(day AS STRING)) AS month, COUNT(*) AS orders,
  COUNT(CASE WHEN datetime(CAST(day AS STRING)) = datetime(order_date) THEN 1 END) AS same_second,
  MIN(CAST(ROUND(day * 86400) AS BIGINT)) AS first_second, MAX(CAST(ROUND(day * 86400) AS BIGINT)) AS last_second
FROM (SELECT order_date, julianday(order_date) AS day FROM stg_orders) WHERE day IS NOT NULL GROUP BY ALL"""

_PER_TEXT = """per_text AS (
  SELECT {group}, {group}_order AS place, r.cuisine, COUNT(*) AS n
  FROM fact_order f JOIN dim_customer c USING (customer_key) JOIN dim_restaurant r USING (restaurant_key)
  WHERE r.cuisine IS NOT NULL GROUP BY ALL
)"""

_SHARE = "CAST(ROUND(CAST(order_count * 100D / {whole} AS DECIMAL(38,8)), 2) AS DOUBLE) AS percentage"

JSON_CUISINES = f"""
WITH {_PER_TEXT.format(group="income_group")},
counted AS (
  SELECT income_group, place, TRIM(j.value) AS single_cuisine, CAST(SUM(n) AS BIGINT) AS order_count
  FROM per_text JOIN LATERAL json_each('["' || REPLACE(cuisine, ',', '","') || '"]') j GROUP BY ALL
),
total AS (SELECT income_group, SUM(order_count) AS whole FROM counted GROUP BY income_group),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY income_group ORDER BY order_count DESC, single_cuisine) AS rank_in_group FROM counted
)
SELECT income_group, single_cuisine, order_count, {_SHARE.format(whole="whole")}
FROM ranked JOIN total USING (income_group) WHERE rank_in_group <= 5 ORDER BY place, order_count DESC, single_cuisine"""

RECURSIVE_CUISINES = f"""
WITH RECURSIVE piece MAX RECURSION LEVEL 10000 AS (
  SELECT cuisine, SUBSTR(cuisine, 1, INSTR(cuisine || ',', ',') - 1) AS head, SUBSTR(cuisine, INSTR(cuisine || ',', ',') + 1) AS rest
  FROM (SELECT DISTINCT cuisine FROM dim_restaurant WHERE cuisine IS NOT NULL)
  UNION ALL
  SELECT cuisine, SUBSTR(rest, 1, INSTR(rest || ',', ',') - 1), SUBSTR(rest, INSTR(rest || ',', ',') + 1) FROM piece WHERE rest <> ''
),
dish AS (SELECT DISTINCT cuisine, TRIM(head) AS top_cuisine FROM piece WHERE head <> ''),
{_PER_TEXT.format(group="education_group")},
counted AS (
  SELECT education_group, place, top_cuisine, CAST(SUM(n) AS BIGINT) AS order_count FROM per_text JOIN dish USING (cuisine) GROUP BY ALL
),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY education_group ORDER BY order_count DESC, top_cuisine) AS pos FROM counted
)
SELECT education_group, top_cuisine, order_count, {_SHARE.format(whole="SUM(order_count) OVER (PARTITION BY education_group)")}
FROM ranked WHERE pos <= 5 ORDER BY place, pos"""


def run_statement(wh: Warehouse, statement: str) -> DataFrame:
    """``statement`` over the warehouse's views; those it names are registered first."""
    register_views(wh.spark, wh, [name for name in VIEWS if re.search(rf"\b{name}\b", statement)])
    return wh.spark.sql(statement)


def order_keys(wh: Warehouse) -> DataFrame:
    """month, label, orders, first_at, last_key of the raw orders."""
    return run_statement(wh, ORDER_KEYS)


def julian_days(wh: Warehouse) -> DataFrame:
    """Raw order dates as Julian days and back, per month."""
    return run_statement(wh, JULIAN_DAYS)


def json_cuisines(wh: Warehouse) -> DataFrame:
    """Five cuisines per income group, split through a JSON text."""
    return run_statement(wh, JSON_CUISINES)


def recursive_cuisines(wh: Warehouse) -> DataFrame:
    """Five cuisines per education group, split by recursion."""
    return run_statement(wh, RECURSIVE_CUISINES)
