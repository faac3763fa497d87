"""Lenient casts: the dynamically typed cell semantics of the source tables.

The source warehouse stores CSV text in INTEGER/REAL columns and casts it
with prefix parsing: ``'' -> 0``, ``'12abc' -> 12``, ``'3.9' -> 3`` (int),
``'--' -> 0.0`` (real), NULL stays NULL. Spark 4 runs ANSI mode where
``cast('' as int)`` raises, so these helpers reproduce the rule with
regexp_extract + try_cast. All work stays JVM-side (no UDF).

Columns that are already numeric are cast directly (doubles truncate toward
zero when cast to integer, as the source does).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, NumericType

_INT_PREFIX = r"^[+-]?[0-9]+"
_ZONE = r"(?:Z|(?<=:[0-9]{2}) ?([+-])([0-9]{2}):([0-9]{2}))$"
_REAL_PREFIX = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def lenient_int(c: Column, dtype: DataType | None = None) -> Column:
    """INTEGER cast (64 bits) with prefix parsing; NULL in, NULL out."""
    if dtype is not None and isinstance(dtype, NumericType):
        return c.try_cast("bigint")
    s = F.trim(c.cast("string"))
    head = F.regexp_extract(s, _INT_PREFIX, 0)
    return (F.when(c.isNull(), F.lit(None).cast("bigint"))
            .when(head == "", F.lit(0).cast("bigint"))
            .otherwise(head.try_cast("bigint")))


def lenient_double(c: Column, dtype: DataType | None = None) -> Column:
    """REAL cast with prefix parsing; unparseable text gives 0.0."""
    if dtype is not None and isinstance(dtype, NumericType):
        return c.cast("double")
    s = F.trim(c.cast("string"))
    head = F.regexp_extract(s, _REAL_PREFIX, 0)
    return (F.when(c.isNull(), F.lit(None).cast("double"))
            .when(head == "", F.lit(0.0))
            .otherwise(head.try_cast("double")))


def iso_timestamp(c: Column) -> Column:
    """Order date text -> TIMESTAMP_NTZ, NULL when not an ISO date.

    A ``YYYY-MM-DD`` guard keeps bare years or numbers from parsing; NTZ keeps
    the session time zone out of every later year/month/day extraction. As the
    source's date functions do, a day beyond the month's end (up to 31) rolls
    into the next month, and a zone suffix (``Z``, ``+05:30``) is applied, giving
    UTC.
    """
    s = F.trim(c.cast("string"))
    # most cells are plain: no zone, a day their month has; the rest is evaluated for the others only
    maybe_zone = s.endswith("Z") | ((F.substring(s, -3, 1) == ":") & F.substring(s, -6, 1).isin("+", "-"))
    plain = F.when(~maybe_zone, s.try_cast("timestamp_ntz"))
    return F.when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.coalesce(plain, _rolled(s)))


def _rolled(s: Column) -> Column:
    """A date text with its zone applied and a day past the month's end rolled over."""
    zone = F.regexp_extract(s, _ZONE, 0)
    part = {i: F.regexp_extract(s, _ZONE, i).try_cast("int") for i in (2, 3)}
    minutes = F.when(part[2].isNull(), 0).otherwise(
        (part[2] * 60 + part[3]) * F.when(F.regexp_extract(s, _ZONE, 1) == "-", -1).otherwise(1))
    day = F.substring(s, 9, 2).try_cast("int")
    first = F.concat(F.substring(s, 1, 8), F.lit("01"), F.substr(s, F.lit(11), F.length(s) - 10 - F.length(zone)))
    shift = F.make_dt_interval(days=day - 1, mins=-minutes)
    return F.when(day.between(1, 31), first.try_cast("timestamp_ntz") + shift)


def plain_number(d: Column) -> Column:
    """A double as decimal text without exponent: at least one digit after the
    point, no other trailing zeros (``250.0``, ``0.00004``). Beyond the range of
    38 digits the double's own text."""
    exact = d.try_cast("decimal(38,18)")
    digits = F.regexp_replace(exact.cast("string"), "0+$", "")
    text = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    return F.when(exact.cast("double") == d, text).otherwise(d.cast("string"))


def _number(c: Column, dtype: DataType | None) -> Column:
    """The cell's value if the whole cell is a number, else NULL."""
    if dtype is not None and isinstance(dtype, NumericType):
        return c.cast("double")
    s = F.trim(c.cast("string"))
    return F.when(s.rlike(_REAL_PREFIX + "$"), s.try_cast("double"))


def real_text(c: Column, dtype: DataType | None = None) -> Column:
    """Text of a cell in a REAL column: a number in one form (``1`` and ``1.0``
    are the same cell), anything else as it stands."""
    n = _number(c, dtype)
    return F.when(n.isNull(), F.trim(c.cast("string"))).otherwise(plain_number(n))


def whole_text(c: Column, dtype: DataType | None = None) -> Column:
    """Text of a cell in an INTEGER column: whole numbers without a point
    (``1.0`` is the cell ``1``), other numbers and texts as in a REAL column."""
    if dtype is not None and isinstance(dtype, IntegralType):
        return c.cast("string")
    n = _number(c, dtype)
    whole = (n == F.floor(n)) & (F.abs(n) < F.lit(9e18))
    return F.when(whole, n.try_cast("bigint").cast("string")).otherwise(real_text(c, dtype))


def raw_text(c: Column) -> Column:
    """``CAST(x AS TEXT)``: the dimension-side natural key form (no normalising)."""
    return c.cast("string")


def _four_digit_year(value: Column, text: Column, other: Column) -> Column:
    return F.when(F.year(value).between(0, 9999), text).when(value.isNotNull(), other)


def ntz_text(ts: Column) -> Column:
    """``strftime('%Y-%m-%d %H:%M:%S')`` of a TIMESTAMP_NTZ: its cast to text knows
    no zone (``date_format`` would pass the value through the session's and move
    wall-clock times inside a daylight-saving gap)."""
    other = F.format_string("%04d-%02d-%02d %02d:%02d:%02d", F.year(ts), F.month(ts),
                            F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.second(ts))
    return _four_digit_year(ts, F.substring(ts.cast("string"), 1, 19), other)


def date_text(d: Column) -> Column:
    """``YYYY-MM-DD`` of a DATE, without any time-zone step."""
    return _four_digit_year(d, d.cast("string"), F.format_string("%04d-%02d-%02d", F.year(d), F.month(d), F.dayofmonth(d)))
