"""Expected results of every query key, in DuckDB SQL over the raw test tables.

One relation, ``line``, holds an enriched row per kept order line: the test-data
rules, the load rules and all attributes are applied to the base tables in one
place, with the label lists as small VALUES tables. Every expected result is then
a grouping of ``line`` (or of ``person``, for customers without orders), put
together by the helpers below from column lists. Nothing here follows the order
of the load, builds its tables first or shares its casts: ids and quantities are
64-bit, amounts are REAL values whose exact decimal text is taken for sums.

Output conventions (functions/numeric.py): a rounded ratio goes through the
shortest text of its double and DECIMAL(38,8); sums are exact decimals, given as
DOUBLE.
"""

from __future__ import annotations

# ------------------------------------------------------------------ helpers


def _exact(expr: str, precision: str) -> str:
    """A double as the decimal that its shortest text names."""
    return f"TRY_CAST(CAST({expr} AS VARCHAR) AS DECIMAL({precision}))"


def _near(expr: str, digits: int) -> str:
    return f"CAST(ROUND({_exact(f'CAST({expr} AS DOUBLE)', '38,8')}, {digits}) AS DOUBLE)"


def _share(part: str, whole: str) -> str:
    return _near(f"CAST({part} AS DOUBLE) * 100.0 / NULLIF(CAST({whole} AS DOUBLE), 0)", 2)


def _plain(x: str) -> str:
    """Decimal text of a REAL cell: one digit after the point at least."""
    digits = f"rtrim(CAST({_exact(x, '38,18')} AS VARCHAR), '0')"
    other = f"replace(upper(CAST({x} AS VARCHAR)), 'E+', '.0E')"
    return f"coalesce(CASE WHEN {digits} LIKE '%.' THEN {digits} || '0' ELSE {digits} END, {other})"


def _report(keys: str, measures: str, source: str = "line", where: str = "", order: str = "",
            also: str = "", limit: int | None = None) -> str:
    """SELECT keys, measures FROM source, grouped by the key expressions (``AS``
    names are dropped for it) and by ``also``."""
    names = [k.split(" AS ")[0].strip() for k in _parts(keys)]
    groups = ", ".join(names + _parts(also))
    return (f"SELECT {keys}, {measures} FROM {source}" + (f" WHERE {where}" if where else "")
            + f" GROUP BY {groups}" + (f" ORDER BY {order}" if order else "") + (f" LIMIT {limit}" if limit else ""))


def _parts(text: str) -> list[str]:
    """Splits at commas outside brackets."""
    out, depth, now = [], 0, ""
    for ch in text:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and not depth:
            out.append(now.strip())
            now = ""
        else:
            now += ch
    return [x for x in [*out, now.strip()] if x]


REVENUE = "CAST(sum(amount) AS DOUBLE)"
MEAN = "CAST(sum(amount) AS DOUBLE) / count(amount)"

# ------------------------------------------------------- the enriched relation

# fixed values: labels of the source warehouse
LABELS = """
income_rule(place, pattern, income_group) AS (VALUES
  (1, 'no income%', 'No Income'), (2, '%below rs.10000%', 'Below 10k'), (3, '%10001 to 25000%', '10k-25k'),
  (4, '%25001 to 50000%', '25k-50k'), (5, '%more than 50000%', '50k+')),
income_rank(income_group, income_order, income_level) AS (VALUES
  ('No Income', 9, 'Unknown'), ('Below 10k', 1, 'Low'), ('10k-25k', 2, 'Middle'), ('25k-50k', 3, 'Middle'),
  ('50k+', 4, 'High'), ('Unknown', 9, 'Unknown')),
school_rule(word, education_group) AS (VALUES
  ('uneducated', 'Basic Education'), ('school', 'Basic Education'), ('post graduate', 'Higher Education'),
  ('graduate', 'Higher Education')),
school_rank(education_group, education_order) AS (VALUES
  ('Unknown', 0), ('Basic Education', 1), ('Higher Education', 2), ('Doctoral', 3)),
family_rule(family_size, family_group) AS (VALUES
  (1, '1 member'), (2, '2 members'), (3, '3 members (one child)')),
month_name(month, month_name) AS (VALUES (1, 'Jan'), (2, 'Feb'), (3, 'Mar'), (4, 'Apr'), (5, 'May'), (6, 'Jun'),
  (7, 'Jul'), (8, 'Aug'), (9, 'Sep'), (10, 'Oct'), (11, 'Nov'), (12, 'Dec')),
holiday(month, day) AS (VALUES (1, 1), (2, 14), (5, 1), (12, 25), (12, 31)),
tier(least_rating, rating_tier) AS (VALUES (4.5, 'Excellent (4.5+)'), (4.0, 'Very Good (4.0-4.4)'),
  (3.5, 'Good (3.5-3.9)'), (3.0, 'Average (3.0-3.4)')),
segment(fewest, most, customer_segment) AS (VALUES (1, 1, 'One-time'), (2, 5, 'Occasional'), (6, 15, 'Regular'),
  (16, 9223372036854775807, 'Frequent'))"""

PEOPLE = """
staged_person AS (
  SELECT c_custkey AS user_id, copy AS seq, CASE copy WHEN 0 THEN c_name ELSE 'DUP' END AS name,
    lower(c_name) || '@example.com' AS email, CAST(18 + c_custkey % 50 AS INTEGER) AS age,
    ['Female', 'Male'][1 + c_custkey % 2] AS gender,
    CASE WHEN c_custkey % 17 <> 0 THEN CAST(1 + c_custkey % 6 AS INTEGER) END AS family_size,
    CASE WHEN c_custkey % 23 <> 0 THEN
      ['No Income', 'Below Rs.10000', '10001 to 25000', '25001 to 50000', 'More than 50000']
      [1 + len(list_filter([1000, 3000, 5000, 7500], lambda b: c_acctbal >= b))] END AS income,
    CASE WHEN c_custkey % 29 = 0 THEN 'ph.d' ELSE map {'AUTOMOBILE': 'Graduate', 'BUILDING': 'Post Graduate',
      'FURNITURE': 'School', 'HOUSEHOLD': 'Ph.D', 'MACHINERY': 'Uneducated'}[c_mktsegment] END AS education
  FROM customer, (VALUES (0), (1)) AS copies(copy) WHERE copy = 0 OR c_custkey % 50 = 0
  UNION ALL
  SELECT base + id, 0, label, NULL, 40, NULL, CAST(id % 5 AS INTEGER), 'More than 50000', 'School'
  FROM (SELECT 3000000000 AS base, o_orderkey AS id, 'Guest' AS label FROM orders WHERE o_orderkey % 16 = 0
        UNION ALL SELECT 6000000000, c_custkey, 'Inactive' FROM customer WHERE c_custkey % 4 = 0)
),
one_person AS (
  SELECT user_id, arg_min(name, seq) AS name, max(email) AS email, max(age) AS age, max(gender) AS gender,
    max(family_size) AS family_size, max(income) AS income, max(education) AS education
  FROM staged_person GROUP BY user_id
),
labelled_person AS (
  SELECT p.*, coalesce((SELECT arg_min(r.income_group, r.place) FROM income_rule r WHERE lower(p.income) LIKE r.pattern),
                       'Unknown') AS income_group,
    CASE WHEN p.education = 'Ph.D' THEN 'Doctoral'
         ELSE coalesce((SELECT s.education_group FROM school_rule s WHERE s.word = lower(p.education)), 'Unknown') END
      AS education_group
  FROM one_person p
),
person AS (
  SELECT row_number() OVER (ORDER BY user_id) AS customer_key, *
  FROM labelled_person JOIN income_rank USING (income_group) JOIN school_rank USING (education_group)
)"""

PLACES = """
staged_place AS (
  SELECT r_name AS country, CASE WHEN n_nationkey % 5 <> 0 THEN concat('State ', n_nationkey % 5) END AS state,
    n_name AS city
  FROM nation LEFT JOIN region ON r_regionkey = n_regionkey
),
place AS (
  SELECT row_number() OVER (ORDER BY country, state NULLS FIRST, city) AS location_key, * FROM (
    SELECT country, state, city, concat(country, '|', state, '|', city) AS location_nk FROM staged_place GROUP BY ALL)
),
kitchen AS (
  SELECT row_number() OVER (ORDER BY s_suppkey) AS restaurant_key, s_suppkey AS id, concat('Kitchen ', s_suppkey % 40) AS restaurant,
    CASE WHEN s_suppkey % 19 = 0 THEN 'Nowhere' ELSE concat('Area ', s_suppkey % 7, ',', lower(n_name)) END AS kitchen_city,
    CASE WHEN s_suppkey % 11 <> 0 THEN (s_suppkey % 51) / CAST(10 AS DOUBLE) END AS rating,
    ['North Indian,Chinese', 'Chinese', ' Biryani , Indian', 'Snacks,', 'Indian,,Snacks', NULL, 'Chinese,Chinese', '']
      [1 + s_suppkey % 8] AS cuisine
  FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
),
served AS (
  SELECT k.restaurant_key, min(p.location_key) AS location_key
  FROM kitchen k JOIN place p ON contains(lower(k.kitchen_city), lower(p.city)) GROUP BY k.restaurant_key
)"""

ORDER_LINES = f"""
copied AS (
  SELECT *, l_orderkey AS ok, o_custkey AS ck, o_orderdate + INTERVAL 6940 DAY + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS shifted
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN (VALUES (0), (1)) AS copies(copy)
    ON copy = 0 OR l_orderkey % 79 = 0 OR (o_custkey % 50 = 0 AND l_suppkey % 10 = 3)
),
staged_line AS (
  SELECT CASE WHEN ck % 31 = 0 THEN -1 - ck WHEN ok % 16 = 0 THEN 3000000000 + ok ELSE ck END AS user_id, l_suppkey AS r_id,
    CASE WHEN ok % 101 <> 0 THEN shifted END AS moment,
    CASE WHEN ok % 101 <> 0 THEN strftime(shifted, '%Y-%m-%d %H:%M:%S') ELSE 'bad-date' END AS order_date,
    CAST(floor(l_quantity) AS BIGINT) AS qty,
    CASE WHEN ok % 97 = 0 THEN 0 WHEN ok % 89 = 0 THEN -1 WHEN ok % 83 = 0 THEN CAST('0.00004' AS DOUBLE)
         WHEN ok % 79 = 0 THEN CAST(['10.00001', '10.00002'][1 + copy] AS DOUBLE)
         WHEN ok % 997 = 0 AND l_linenumber = 1 THEN CAST('1e15' AS DOUBLE)
         WHEN ok % 991 = 0 AND l_linenumber = 1 THEN CAST('1e30' AS DOUBLE) ELSE l_extendedprice END AS cell,
    CASE l_returnflag WHEN 'A' THEN ' USD ' WHEN 'N' THEN 'INR' WHEN 'R' THEN CASE l_linestatus WHEN 'F' THEN 'usd' END END AS currency
  FROM copied
),
named_line AS (
  SELECT *, concat_ws('|', user_id, r_id, coalesce(strftime(moment, '%Y-%m-%d %H:%M:%S'), ''), coalesce(trim(currency), ''), qty, {_plain('cell')}) AS order_nk,
    CASE WHEN lower(trim(currency)) = 'usd' THEN 87 ELSE 1 END AS rate, {_exact('cell', '28,10')} AS money
  FROM staged_line
),
known_line AS (
  SELECT DISTINCT order_nk, moment, customer_key, restaurant_key, qty, cell * rate AS real_amount,
    TRY_CAST(money * rate AS DECIMAL(28,10)) AS amount, CASE rate WHEN 87 THEN 'INR' ELSE trim(currency) END AS currency, order_date
  FROM named_line n JOIN person p USING (user_id) JOIN kitchen k ON k.id = n.r_id
  WHERE moment IS NOT NULL
),
numbered_line AS (
  SELECT row_number() OVER (ORDER BY order_nk) AS order_key, * FROM known_line WHERE amount IS NOT NULL
),
day AS (
  SELECT DISTINCT CAST(moment AS DATE) AS date, CAST(strftime(moment, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(extract(year FROM moment) AS INTEGER) AS year, CAST(extract(quarter FROM moment) AS INTEGER) AS quarter,
    CAST(extract(month FROM moment) AS INTEGER) AS month, CAST(extract(day FROM moment) AS INTEGER) AS day,
    CAST(extract(dow FROM moment) + 1 AS INTEGER) AS dow
  FROM staged_line WHERE moment IS NOT NULL
),
calendar AS (
  SELECT d.*, CAST(d.date AS VARCHAR) AS date_iso, m.month_name, CAST(dow IN (1, 7) AS INTEGER) AS is_weekend,
    CAST((d.month, d.day) IN (SELECT (month, day) FROM holiday) AS INTEGER) AS is_holiday
  FROM day d JOIN month_name m USING (month)
),
line AS (
  SELECT n.*, p.income_group, p.income_order, p.income_level, p.education_group, p.education_order,
    coalesce(f.family_group, CASE WHEN p.family_size IS NULL THEN 'Unknown' ELSE '4+ members (>=2 children)' END) AS family_group,
    k.restaurant, k.rating, k.cuisine, s.location_key, l.country, l.state, l.city,
    c.date_key, c.year, c.quarter, c.month, c.month_name, c.is_weekend, c.is_holiday,
    coalesce((SELECT arg_max(t.rating_tier, t.least_rating) FROM tier t WHERE k.rating >= t.least_rating), 'Below Average (<3.0)') AS rating_tier
  FROM numbered_line n JOIN person p USING (customer_key) JOIN kitchen k USING (restaurant_key)
  JOIN calendar c ON c.date = CAST(n.moment AS DATE)
  LEFT JOIN family_rule f USING (family_size) LEFT JOIN served s USING (restaurant_key) LEFT JOIN place l USING (location_key)
  WHERE real_amount NOT IN (0, -1)
),
spending AS (
  SELECT customer_key, count(*) AS orders, sum(amount) AS spent, min(year) AS first_year, min(month) AS first_month
  FROM line GROUP BY customer_key
),
member AS (SELECT * FROM person LEFT JOIN spending USING (customer_key)),
dish AS (
  SELECT order_key, income_group, income_order, education_group, education_order, piece, trim(piece) AS dish
  FROM (SELECT *, unnest(string_split(cuisine, ',')) AS piece FROM line)
),
festival AS (
  SELECT year, restaurant_key, restaurant, city, cuisine, rating, count(*) AS orders, sum(amount) AS sales
  FROM line WHERE location_key IS NOT NULL AND month IN (10, 11) AND year BETWEEN 2017 AND 2019 GROUP BY ALL
),
winner AS (
  SELECT f.* FROM festival f JOIN (SELECT year, max(sales) AS sales FROM festival GROUP BY year) USING (year, sales)
)"""

PREFIX = "WITH " + ",".join([LABELS, PEOPLE, PLACES, ORDER_LINES]).strip() + "\n"

# ------------------------------------------------------------------ results


def _popular(group: str, count: str, where: str = "TRUE") -> str:
    """The five dishes with the largest count in every group."""
    order = group.replace("_group", "_order")
    return f"""SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY n DESC, dish) AS pos,
  sum(n) OVER (PARTITION BY {group}) AS all_n
FROM (SELECT {group}, {order} AS place, dish, {count} AS n FROM dish WHERE {where} GROUP BY ALL)"""


_BY_INCOME = (f"SELECT income_group, dish AS single_cuisine, n AS order_count, {_share('n', 'all_n')} AS percentage, place "
              f"FROM ({_popular('income_group', 'count(*)')}) WHERE pos <= 5")
_BY_EDUCATION = (f"SELECT education_group, dish AS top_cuisine, n AS order_count, "
                 f"{_share('n', 'sum(n) OVER (PARTITION BY education_group)')} AS percentage, place, pos "
                 f"FROM (SELECT * FROM ({_popular('education_group', 'count(DISTINCT order_key)', chr(39) + chr(39) + ' <> piece')}) WHERE pos <= 5)")

_FREQUENCY = _report(
    "income_group", f"count(*) AS customer_count, CAST(coalesce(sum(orders), 0) AS BIGINT) AS total_orders, "
    f"{_near('coalesce(sum(orders), 0) / CAST(count(*) AS DOUBLE)', 2)} AS avg_orders_per_customer",
    "member", order="income_order", also="income_order")

_TOP = _report(
    "restaurant AS restaurant_name, city, country, cuisine",
    f"{_near('max(rating)', 6)} AS avg_rating, count(*) AS total_orders, {REVENUE} AS total_sales, {_near(MEAN, 6)} AS avg_order_value",
    where="location_key IS NOT NULL", also="rating", limit=10,
    order="sum(amount) DESC, rating DESC NULLS LAST, restaurant, city, country, cuisine NULLS FIRST")


def _family(flag: str, yes: str, no: str) -> str:
    return _report(
        f"family_group, income_level, CASE {flag} WHEN 1 THEN '{yes}' ELSE '{no}' END AS day_type",
        f"count(*) AS orders, CAST(sum(qty) AS BIGINT) AS total_sales_quantity, {REVENUE} AS total_sales_amount, "
        f"{_near(MEAN, 2)} AS avg_order_value", order="total_sales_amount DESC")


_DAYTYPE, _HOLIDAY = _family("is_weekend", "Weekend", "Weekday"), _family("is_holiday", "Holiday", "Regular Day")
_FACT = """order_key, order_nk, date_key, customer_key, restaurant_key, qty AS sales_qty,
  CAST(amount AS DOUBLE) AS sales_amount, currency, location_key"""


def _slug(label: str) -> str:
    return "_".join("".join(ch.lower() if ch.isalnum() else " " for ch in label).split())


def _columns(source: str, row: str, group: str, labels: tuple[str, ...]) -> str:
    shares = ", ".join(f"max(percentage) FILTER ({group} = '{x}') AS pct_{_slug(x)}" for x in labels)
    return f"SELECT {row}, {shares} FROM ({source}) GROUP BY {row} ORDER BY {row}"


def _box(source: str, keys: str) -> str:
    marks = (("aov_min", 0.0), ("aov_q1", 0.25), ("aov_median", 0.5), ("aov_q3", 0.75), ("aov_max", 1.0))
    return _report(keys, ", ".join(f"{_near(f'quantile_cont(avg_order_value, {p})', 6)} AS {n}" for n, p in marks),
                   f"({source})", order=keys)


def _checks(value: str, rows: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS check_name, ({query}) AS {value}" for name, query in rows.items())


_BATCHES = """, first_load AS (
  SELECT * REPLACE (row_number() OVER (ORDER BY order_nk) AS order_key) FROM numbered_line WHERE order_date < '2018-07-01'
), first_kept AS (SELECT * FROM first_load WHERE real_amount NOT IN (0, -1)
), second_load AS (
  SELECT * REPLACE ((SELECT coalesce(max(order_key), 0) FROM first_kept) + row_number() OVER (ORDER BY order_nk) AS order_key)
  FROM numbered_line WHERE order_date >= '2018-01-01' AND order_nk NOT IN (SELECT order_nk FROM first_kept)
), loaded AS (SELECT * FROM first_kept UNION ALL SELECT * FROM second_load WHERE real_amount NOT IN (0, -1))
SELECT order_key, order_nk, CAST(strftime(moment, '%Y%m%d') AS INTEGER) AS date_key, customer_key, restaurant_key,
  qty AS sales_qty, CAST(amount AS DOUBLE) AS sales_amount, currency, location_key
FROM loaded LEFT JOIN served USING (restaurant_key)"""

_CUSTOMER = """customer_key, CAST(user_id AS VARCHAR) AS user_id_nat, name, email, age, gender, family_size,
  income AS monthly_income_raw, income_group, income_order AS income_group_order, education AS education_raw,
  education_group, education_order AS education_group_order"""

_BODIES: dict[str, str] = {
    "rq1_1_income_distribution": _report(
        "income_group", f"count(*) AS customer_count, {_share('count(*)', '(SELECT count(*) FROM person)')} AS percentage",
        "person", order="income_order", also="income_order"),
    "rq1_2_income_frequency": _FREQUENCY,
    "rq1_3_income_spending": _report(
        "income_group", "CAST(coalesce(sum(orders), 0) AS BIGINT) AS order_count, "
        "CAST(ROUND(CAST(sum(spent) AS DECIMAL(38,8)), 2) AS DOUBLE) AS total_spending, "
        f"{_near('CAST(sum(spent) AS DOUBLE) / sum(orders)', 2)} AS avg_order_value, "
        f"{_near('CAST(sum(spent) AS DOUBLE) / count(*)', 2)} AS avg_spending_per_customer",
        "member", order="income_order", also="income_order"),
    "rq1_4_cuisine_by_income": f"SELECT * EXCLUDE (place) FROM ({_BY_INCOME}) ORDER BY place, order_count DESC",
    "rq1_5_education_behaviour": _report(
        "education_group", "count(*) AS customer_count, CAST(sum(orders) AS BIGINT) AS total_orders, "
        f"{_near('sum(orders) / CAST(count(*) AS DOUBLE)', 2)} AS avg_orders_per_customer, "
        f"CAST(sum(spent) AS DOUBLE) AS total_sales, {_near('CAST(sum(spent) AS DOUBLE) / count(*)', 2)} AS avg_spend_per_customer",
        "member", where="orders > 0", order="education_order", also="education_order"),
    "rq1_6_cuisine_by_education": f"SELECT * EXCLUDE (place, pos) FROM ({_BY_EDUCATION}) ORDER BY place, pos",
    "rq1_7_weekend_by_education": "SELECT education_group, day_type, order_count, "
        f"{_share('order_count', 'sum(order_count) OVER (PARTITION BY education_group)')} AS percentage FROM ("
        + _report("education_group, CASE is_weekend WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type", "count(*) AS order_count") + ")",
    "rq2_1_top_restaurants": _TOP,
    "rq2_2_festival_top": "SELECT restaurant_key, restaurant AS restaurant_name, city, cuisine, rating, year, "
        "orders AS total_orders, CAST(sales AS DOUBLE) AS total_sales FROM winner",
    "rq2_3_rating_tiers": _report(
        "rating_tier", f"count(DISTINCT restaurant_key) AS restaurant_count, count(*) AS total_orders, "
        f"{REVENUE} AS total_revenue, {_near(MEAN, 2)} AS avg_order_value"),
    "rq2_4_cuisine_performance": _report(
        "cuisine", f"count(DISTINCT restaurant_key) AS restaurant_count, count(*) AS total_orders, {REVENUE} AS total_revenue, "
        f"{_near(MEAN, 2)} AS avg_order_value, {_near('avg(rating)', 2)} AS avg_restaurant_rating",
        order="sum(amount) DESC, cuisine NULLS FIRST", limit=15),
    "rq3_1_family_view": "SELECT order_key, qty AS sales_qty, CAST(amount AS DOUBLE) AS sales_amount, family_group, income_level, "
        "is_weekend, is_holiday, cuisine FROM line",
    "rq3_2_family_daytype": _DAYTYPE,
    "rq3_3_family_holiday": _HOLIDAY,
    "rq3_4_family_cuisine": _report(
        "cuisine, family_group, income_level, CASE is_weekend WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type",
        f"count(*) AS orders, CAST(sum(qty) AS BIGINT) AS total_sales_quantity, {REVENUE} AS total_sales_amount, "
        f"{_near(MEAN, 2)} AS avg_order_value", where="cuisine IS NOT NULL",
        order="sum(amount) DESC, cuisine, family_group, income_level, day_type", limit=20),
    "rq3_5_family_revenue_share": _report(
        "family_group, income_level", f"count(*) AS total_orders, {REVENUE} AS total_revenue, {_near(MEAN, 2)} AS avg_order_value, "
        f"{_share('sum(amount)', '(SELECT sum(amount) FROM line)')} AS revenue_percentage"),
    "bi1_monthly_revenue": _report(
        "year, month, month_name", f"count(*) AS total_orders, {REVENUE} AS total_revenue, {_near(MEAN, 2)} AS avg_order_value, "
        "count(DISTINCT customer_key) AS unique_customers"),
    "bi2_loyalty": _report(
        "customer_segment", f"count(*) AS customer_count, {_near('avg(orders)', 1)} AS avg_orders_per_customer, "
        f"{_near('CAST(sum(spent) AS DOUBLE) / count(*)', 2)} AS avg_total_spent, "
        f"{_near('avg(CAST(spent AS DOUBLE) / orders)', 2)} AS avg_order_value",
        "spending JOIN segment ON orders BETWEEN fewest AND most"),
    "bi3_geography": _report(
        "country, state, city", f"count(DISTINCT restaurant_key) AS restaurant_count, count(*) AS total_orders, "
        f"{REVENUE} AS total_revenue, {_near(MEAN, 2)} AS avg_order_value, {_near('avg(rating)', 2)} AS avg_restaurant_rating",
        where="location_key IS NOT NULL", order="sum(amount) DESC, country, state NULLS FIRST, city", limit=20),
    "bi4_seasonality": _report(
        "quarter, month_name", f"count(*) AS total_orders, {REVENUE} AS total_revenue, {_near(MEAN, 2)} AS avg_order_value, "
        f"{_share('sum(amount)', '(SELECT sum(amount) FROM line)')} AS revenue_percentage"),
    "bi5_acquisition": "SELECT a.*, (SELECT CAST(sum(new_customers) AS BIGINT) FROM firsts b WHERE (b.first_order_year, b.first_order_month) "
        "<= (a.first_order_year, a.first_order_month)) AS cumulative_customers FROM firsts a",
    "readme_income_spend": _report("income_group", f"count(*) AS customer_count, {_near(MEAN, 2)} AS avg_spending"),
    "readme_top_restaurants": _report(
        "restaurant AS restaurant_name, city, cuisine", f"{_near('avg(rating)', 6)} AS avg_rating, {REVENUE} AS total_sales",
        where="location_key IS NOT NULL", order="sum(amount) DESC, restaurant, city, cuisine NULLS FIRST", limit=10),
    "etl_dim_date": "SELECT date_key, date_iso, year, quarter, month, month_name, day, dow, is_weekend FROM calendar",
    "etl_dim_customer": f"SELECT {_CUSTOMER} FROM person",
    "etl_dim_restaurant": "SELECT restaurant_key, CAST(id AS VARCHAR) AS restaurant_id_nat, restaurant AS name, kitchen_city AS city, "
        "rating, cuisine FROM kitchen",
    "etl_dim_location": "SELECT location_key, location_nk, country, state, city FROM place",
    "etl_fact_order": f"SELECT {_FACT} FROM line",
    "etl_fact_incremental": _BATCHES,
    "etl_dim_incremental": f"SELECT {_CUSTOMER.replace('customer_key', 'row_number() OVER (ORDER BY user_id % 2 = 0, user_id) AS customer_key', 1)} FROM person",
    "etl_location_repatch": """, early AS (
  SELECT row_number() OVER (ORDER BY state IS NOT NULL, country, state, city) AS number, * FROM place
), matched AS (
  SELECT k.restaurant_key, coalesce(min(e.number) FILTER (e.state IS NULL), min(e.number)) AS number
  FROM kitchen k JOIN early e ON contains(lower(k.kitchen_city), lower(e.city)) GROUP BY k.restaurant_key
)
SELECT order_key, number AS location_key FROM line LEFT JOIN matched USING (restaurant_key)""",
    "stg_csv_roundtrip": "SELECT currency, count(*) AS n_rows, count(DISTINCT user_id) AS n_users, CAST(sum(qty) AS BIGINT) AS qty, "
        f"count(*) FILTER (moment IS NULL) AS bad_dates, CAST(sum({_exact('cell', '38,5')}) AS DOUBLE) AS amount FROM staged_line GROUP BY currency",
    "v_stg_orders_nk": "SELECT order_nk, user_id, r_id, order_date, CAST(qty AS INTEGER) AS sales_qty, cell AS sales_amount, currency FROM named_line",
    "v_new_dates": "SELECT date_key, date_iso, year, quarter, month, month_name, day, dow, is_weekend FROM calendar",
    "v_fact_load": "SELECT order_nk, CAST(strftime(moment, '%Y%m%d') AS INTEGER) AS date_key, customer_key, restaurant_key, "
        "qty AS sales_qty, cell AS sales_amount, trim(currency) AS currency FROM named_line JOIN person USING (user_id) "
        "JOIN kitchen ON id = r_id WHERE moment IS NOT NULL",
    "qa_row_counts": "SELECT * FROM (SELECT (SELECT count(*) FROM line) AS fact_order, (SELECT count(*) FROM person) AS dim_customer, "
        "(SELECT count(*) FROM kitchen) AS dim_restaurant, (SELECT count(*) FROM calendar) AS dim_date, "
        "(SELECT count(*) FROM place) AS dim_location) UNPIVOT (c FOR t IN (fact_order, dim_customer, dim_restaurant, dim_date, dim_location))",
    "qa_fk_orphans": _checks("rows", {
        "date_fk_orphans": "SELECT count(*) FROM line WHERE date_key IS NULL OR date_key NOT IN (SELECT date_key FROM calendar)",
        "customer_fk_orphans": "SELECT count(*) FROM line WHERE customer_key IS NULL OR customer_key NOT IN (SELECT customer_key FROM person)",
        "restaurant_fk_orphans": "SELECT count(*) FROM line WHERE restaurant_key IS NULL OR restaurant_key NOT IN (SELECT restaurant_key FROM kitchen)",
        "location_fk_orphans": "SELECT count(*) FROM line WHERE location_key NOT IN (SELECT location_key FROM place)"}),
    "qa_location_count": "SELECT max(location_key) AS dim_location_rows FROM place",
    "qa_location_sample": "SELECT location_key, country, state, city FROM place WHERE location_key <= 20",
    "dq_duplicate_users": "SELECT user_id, 1 + max(seq) AS n_rows FROM staged_person GROUP BY user_id HAVING max(seq) > 0",
    "dq_invalid_dates": "SELECT count(*) FILTER (coalesce(order_date, '') = '') AS invalid_dates, "
        "count(*) FILTER (moment IS NULL AND order_date > '') AS unparseable_dates FROM staged_line",
    "dq_negative_amounts": "SELECT count(*) AS negative_amounts FROM staged_line WHERE sign(cell) = -1",
    "dq_null_keys": _checks("rows", {"null_user_ids": "SELECT count(*) - count(user_id) FROM staged_person",
                                     "null_restaurant_ids": "SELECT count(*) - count(id) FROM kitchen"}),
    "dq_unique_keys": _checks("duplicate_keys", {
        f"{table}.{name}": f"SELECT count(*) FROM (SELECT {column} FROM {source} GROUP BY {column} HAVING count({column}) > 1)"
        for table, source, names in (
            ("dim_date", "calendar", {"date_key": "date_key", "date_iso": "date_iso"}),
            ("dim_customer", "person", {"customer_key": "customer_key", "user_id_nat": "user_id"}),
            ("dim_restaurant", "kitchen", {"restaurant_key": "restaurant_key", "restaurant_id_nat": "id"}),
            ("dim_location", "place", {"location_key": "location_key", "location_nk": "location_nk"}),
            ("fact_order", "line", {"order_key": "order_key", "order_nk": "order_nk"}))
        for name, column in names.items()}),
    "dq_rejected_amounts": "SELECT count(*) AS rejected_amounts FROM named_line WHERE moment IS NOT NULL AND TRY_CAST(money * rate AS DECIMAL(28,10)) IS NULL",
    "feed_income_mix": f"SELECT income_group, customer_count, {_share('customer_count', '(SELECT count(*) FROM person)')} AS share_pct, "
        f"format('{{:,}}', customer_count) AS customer_count_label FROM ({_FREQUENCY})",
    "feed_avg_orders_range": f"SELECT min(avg_orders_per_customer) AS min_avg_orders, max(avg_orders_per_customer) AS max_avg_orders FROM ({_FREQUENCY})",
    "feed_cuisine_pivot_education": _columns(_BY_EDUCATION, "top_cuisine", "education_group",
                                             ("Unknown", "Basic Education", "Higher Education", "Doctoral")),
    "feed_cuisine_pivot_income": _columns(_BY_INCOME, "single_cuisine", "income_group",
                                          ("No Income", "Below 10k", "10k-25k", "25k-50k", "50k+", "Unknown")),
    "feed_aov_box_daytype": _box(_DAYTYPE, "day_type"),
    "feed_aov_box_income_holiday": _box(_HOLIDAY, "income_level, day_type"),
    "feed_aov_weekday": _report("family_group, income_level", f"{_near('avg(avg_order_value)', 6)} AS mean_aov", f"({_DAYTYPE})",
                                where="day_type = 'Weekday'"),
    "feed_aov_holiday": _report("family_group, day_type", f"{_near('avg(avg_order_value)', 6)} AS mean_aov", f"({_HOLIDAY})"),
    "feed_top_restaurants": "SELECT row_number() OVER (ORDER BY total_sales DESC, avg_rating DESC NULLS LAST, restaurant_name, city, country, "
        f"cuisine NULLS FIRST) AS sales_rank, restaurant_name, city, total_sales, avg_order_value FROM ({_TOP})",
    "feed_rating_vs_orders": f"SELECT restaurant_name, city, avg_rating, total_orders FROM ({_TOP})",
    "feed_festival_by_year": _report("year", f"{_near('avg(CAST(sales AS DOUBLE))', 6)} AS avg_total_sales", "winner"),
}

_FIRSTS = """, firsts AS (
  SELECT first_year AS first_order_year, first_month AS first_order_month, count(*) AS new_customers FROM spending GROUP BY ALL)
"""

SQL: dict[str, str] = {key: PREFIX + (_FIRSTS if key == "bi5_acquisition" else "") + body for key, body in _BODIES.items()}
