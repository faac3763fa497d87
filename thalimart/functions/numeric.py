"""Money and ratio arithmetic that gives the same digits on every engine.

Rules (see README "Numeric rules"):
* money is stored as DECIMAL(28,10) so SUM is exact and independent of
  partitioning; sums are cast to DOUBLE only at output;
* a double ratio is never rounded directly: it goes through DECIMAL(38,8)
  first, which removes binary noise before the half-up rounding;
* literals are doubles (``100.0`` in Spark SQL would be a DECIMAL);
* divisions are guarded (ANSI mode raises on x/0; the source gives NULL).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,10)"


def out_money(c: Column) -> Column:
    """Exact decimal sum -> double at the output boundary."""
    return c.cast("double")


def wide_sum(c: Column) -> Column:
    """Exact SUM of a DECIMAL(38,5), as a double. The sum itself may need more
    than 38 digits (ANSI mode raises then), so the multiples of 10^15 and the
    rest are summed apart and put together as text, which is rounded once."""
    step = F.lit("1000000000000000").cast("decimal(16,0)")
    quotient = F.call_function("div", c, step).cast("decimal(38,0)")
    high, low = F.sum(quotient), F.sum((c % step).cast("decimal(38,5)"))
    rest = F.pmod(low, step)                  # 0 <= rest < 10^15
    whole = high + F.call_function("div", low - rest, step)
    borrow = (whole < 0) & (rest > 0)
    size = F.when(borrow, -whole - 1).otherwise(F.abs(whole))
    tail = F.when(borrow, step - rest).otherwise(rest).cast("decimal(20,5)")
    text = F.concat(F.when(whole < 0, "-").otherwise(""), size.cast("decimal(38,0)").cast("string"), F.lpad(tail.cast("string"), 21, "0"))
    return text.cast("double")


def money_round(c: Column, digits: int) -> Column:
    """ROUND(x, d) done identically in Spark and the SQL oracle."""
    return F.round(c.cast("decimal(38,8)"), digits).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """num / den as double; NULL when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), F.nullif(den, F.lit(0)).cast("double"))


def percent(num: Column, den: Column, digits: int = 2) -> Column:
    """ROUND(num * 100.0 / den, d)."""
    return money_round(safe_div(num.cast("double") * F.lit(100.0), den), digits)


def avg_money(c: Column) -> Column:
    """AVG over a DECIMAL money column, as double (NULL for no rows)."""
    return safe_div(F.sum(c), F.count(c))
