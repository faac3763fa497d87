"""Expected results of the extended keys, over the relations of ``oracle``."""

from __future__ import annotations

from .oracle import PREFIX, SQL

#: Every natural key, and every line without one, with the reason against it.
_DECIDED = """, sound AS (
  SELECT n.*, TRY_CAST(money * rate AS DECIMAL(28,10)) IS NULL AS too_large FROM named_line n
), judged AS (
  SELECT CASE WHEN moment IS NULL THEN 'bad_date' ELSE 'amount_too_large' END AS reason, currency, 1 AS copies FROM sound WHERE moment IS NULL OR too_large
  UNION ALL
  SELECT CASE WHEN user_id NOT IN (SELECT user_id FROM person) THEN 'unknown_user' WHEN r_id NOT IN (SELECT id FROM kitchen) THEN 'unknown_restaurant'
    WHEN cell * rate IN (0, -1) THEN 'deleted_amount' ELSE 'accepted' END, any_value(currency), count(*)
  FROM sound WHERE moment IS NOT NULL AND NOT too_large GROUP BY order_nk, user_id, r_id, cell * rate
)
"""

_BODIES: dict[str, str] = {
    "dq_load_reasons": _DECIDED + """SELECT reason, CAST(CASE reason WHEN 'duplicate' THEN (SELECT sum(copies - 1) FROM judged)
  ELSE (SELECT count(*) FROM judged j WHERE j.reason = r.reason) END AS BIGINT) AS orders
FROM (VALUES ('bad_date'), ('no_quantity'), ('no_amount'), ('amount_too_large'), ('unknown_user'), ('unknown_restaurant'), ('deleted_amount'),
  ('accepted'), ('duplicate')) AS r(reason)""",
    "like_location_match": """SELECT kitchen_city AS city, min(location_key) AS location_key FROM kitchen
JOIN (SELECT location_key, regexp_replace(regexp_replace(city, '[AEIOU]', '_', 'g'), '[0-9]', '%', 'g') AS pattern FROM place)
ON lower(kitchen_city) LIKE '%' || lower(pattern) || '%' GROUP BY kitchen_city""",
    "csv_users": """SELECT income AS monthly_income, count(*) AS n_rows, count(*) FILTER (user_id % 10 = 3) AS surplus_lines,
  count(*) FILTER (user_id % 10 = 7) AS short_lines, count(DISTINCT user_id) FILTER (user_id % 10 <> 7) AS n_ids, CAST(sum(age) AS BIGINT) AS ages
FROM staged_person GROUP BY income""",
    "csv_restaurants": """SELECT nullif(cuisine, '') AS cuisine, count(*) AS n_rows, count(*) FILTER (id % 10 = 3) AS surplus_lines,
  count(*) FILTER (id % 10 = 7) AS short_lines, count(DISTINCT id) FILTER (id % 10 <> 7) AS n_ids,
  CAST(sum(CAST(rating AS DECIMAL(38,5))) AS DOUBLE) AS ratings FROM kitchen GROUP BY ALL""",
    "csv_locations": """SELECT state, count(*) AS n_rows, count(*) FILTER (city LIKE '%3') AS surplus_lines, count(*) FILTER (city LIKE '%7') AS short_lines,
  count(country) FILTER (city NOT LIKE '%7') AS n_countries, count(DISTINCT city) AS cities
FROM (SELECT p.* FROM staged_place p, (VALUES (0), (1)) AS copies(copy) WHERE copy = 0 OR city IN (SELECT n_name FROM nation WHERE n_nationkey < 5)) GROUP BY state""",
    "dq_quarantine": _DECIDED + "SELECT reason, currency, count(*) AS orders, CAST(sum(copies) AS BIGINT) AS copies FROM judged WHERE reason <> 'accepted' GROUP BY reason, currency",
    "sql_order_keys": """SELECT strftime(moment, '%Y%m') AS month, concat(trim(currency), '|', strftime(moment, '%w')) AS label, count(*) AS orders,
  min(strftime(moment, '%Y-%m-%d %H:%M:%S')) AS first_at, max(concat(format('{:08d}', r_id), '/', strftime(moment, '%j'))) AS last_key
FROM staged_line GROUP BY ALL""",
    "sql_julian_days": """SELECT strftime(moment, '%Y-%m') AS month, count(*) AS orders, count(*) AS same_second,
  min(second) AS first_second, max(second) AS last_second
FROM (SELECT moment, CAST(epoch(moment) AS BIGINT) + 210866760000 AS second FROM staged_line) WHERE moment IS NOT NULL GROUP BY ALL""",
    "state_distinct_customers": """SELECT CASE WHEN grouping(month) = 0 THEN 'month' WHEN grouping(quarter) = 0 THEN 'quarter' ELSE 'year' END AS level,
  year, quarter, month, count(DISTINCT customer_key) AS customers FROM line GROUP BY GROUPING SETS ((year, quarter, month), (year, quarter), (year))""",
}

SQL_EXTENDED: dict[str, str] = {key: PREFIX + body for key, body in _BODIES.items()} | {
    "sql_json_cuisines": SQL["rq1_4_cuisine_by_income"],
    "sql_recursive_cuisines": SQL["rq1_6_cuisine_by_education"],
    "state_monthly_revenue": SQL["bi1_monthly_revenue"],
    "state_loyalty": SQL["bi2_loyalty"],
    "state_acquisition": SQL["bi5_acquisition"],
}
