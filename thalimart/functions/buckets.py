"""Bucketing rules of the warehouse, as Column expressions (when-chains).

Fixed values (must equal the source warehouse's labels and orders):

  income patterns on lower(monthly_income_raw), first match wins:
    starts with 'no income'           -> 'No Income'
    contains    'below rs.10000'      -> 'Below 10k'
    contains    '10001 to 25000'      -> '10k-25k'
    contains    '25001 to 50000'      -> '25k-50k'
    contains    'more than 50000'     -> '50k+'
    otherwise (NULL too)              -> 'Unknown'
  income_group_order: 'None' 0, 'Below 10k' 1, '10k-25k' 2, '25k-50k' 3,
    '50k+' 4, else 9   ('No Income' is not 'None', so it gets 9)
  education on lower(raw): 'uneducated','school' -> 'Basic Education';
    'post graduate','graduate' -> 'Higher Education';
    raw exactly 'Ph.D' (case-sensitive) -> 'Doctoral'; else 'Unknown'
  education_group_order: Basic 1, Higher 2, Doctoral 3, else 0
  family_group: 1 '1 member', 2 '2 members', 3 '3 members (one child)',
    NULL 'Unknown', anything else '4+ members (>=2 children)'
  income_level: ('None','Below 10k') 'Low', ('10k-25k','25k-50k') 'Middle',
    '50k+' 'High', else 'Unknown'
  rating_tier: >=4.5 'Excellent (4.5+)', >=4.0 'Very Good (4.0-4.4)',
    >=3.5 'Good (3.5-3.9)', >=3.0 'Average (3.0-3.4)', else (NULL too)
    'Below Average (<3.0)'
  holidays (month-day): 01-01, 02-14, 05-01, 12-25, 12-31
  loyalty segment by order count: 1 'One-time', 2-5 'Occasional',
    6-15 'Regular', else 'Frequent'
  USD -> INR rate: 87; invalid amounts after conversion: 0.0 and -1.0
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

USD_TO_INR = 87
INVALID_AMOUNTS = (0.0, -1.0)
HOLIDAYS = ((1, 1), (2, 14), (5, 1), (12, 25), (12, 31))
MONTH_ABBR = ("Jan", "Feb", "Mar", "Apr", "May", "Jun",
              "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

INCOME_GROUPS = ("No Income", "Below 10k", "10k-25k", "25k-50k", "50k+", "Unknown")
EDUCATION_GROUPS = ("Unknown", "Basic Education", "Higher Education", "Doctoral")


def income_group(raw: Column) -> Column:
    s = F.lower(raw)
    return (F.when(s.startswith("no income"), "No Income")
            .when(s.contains("below rs.10000"), "Below 10k")
            .when(s.contains("10001 to 25000"), "10k-25k")
            .when(s.contains("25001 to 50000"), "25k-50k")
            .when(s.contains("more than 50000"), "50k+")
            .otherwise("Unknown"))


def income_group_order(group: Column) -> Column:
    return (F.when(group == "None", 0)
            .when(group == "Below 10k", 1)
            .when(group == "10k-25k", 2)
            .when(group == "25k-50k", 3)
            .when(group == "50k+", 4)
            .otherwise(9))


def education_group(raw: Column) -> Column:
    s = F.lower(raw)
    return (F.when(s.isin("uneducated", "school"), "Basic Education")
            .when(s.isin("post graduate", "graduate"), "Higher Education")
            .when(raw == "Ph.D", "Doctoral")
            .otherwise("Unknown"))


def education_group_order(group: Column) -> Column:
    return (F.when(group == "Basic Education", 1)
            .when(group == "Higher Education", 2)
            .when(group == "Doctoral", 3)
            .otherwise(0))


def family_group(size: Column) -> Column:
    return (F.when(size == 1, "1 member")
            .when(size == 2, "2 members")
            .when(size == 3, "3 members (one child)")
            .when(size.isNull(), "Unknown")
            .otherwise("4+ members (>=2 children)"))


def income_level(group: Column) -> Column:
    return (F.when(group.isin("None", "Below 10k"), "Low")
            .when(group.isin("10k-25k", "25k-50k"), "Middle")
            .when(group == "50k+", "High")
            .otherwise("Unknown"))


def rating_tier(rating: Column) -> Column:
    return (F.when(rating >= 4.5, "Excellent (4.5+)")
            .when(rating >= 4.0, "Very Good (4.0-4.4)")
            .when(rating >= 3.5, "Good (3.5-3.9)")
            .when(rating >= 3.0, "Average (3.0-3.4)")
            .otherwise("Below Average (<3.0)"))


def is_holiday(month: Column, day: Column) -> Column:
    cond = F.lit(False)
    for m, d in HOLIDAYS:
        cond = cond | ((month == m) & (day == d))
    return F.when(cond, 1).otherwise(0)


def loyalty_segment(n_orders: Column) -> Column:
    return (F.when(n_orders == 1, "One-time")
            .when(n_orders.between(2, 5), "Occasional")
            .when(n_orders.between(6, 15), "Regular")
            .otherwise("Frequent"))


def weekend_label(flag: Column) -> Column:
    return F.when(flag == 1, "Weekend").otherwise("Weekday")


def holiday_label(flag: Column) -> Column:
    return F.when(flag == 1, "Holiday").otherwise("Regular Day")


def month_abbr(month: Column) -> Column:
    expr = F.lit(None).cast("string")
    out = None
    for i, name in enumerate(MONTH_ABBR, start=1):
        out = (F.when(month == i, name) if out is None else out.when(month == i, name))
    return out.otherwise(expr)


def is_usd(currency: Column) -> Column:
    return F.lower(currency) == "usd"
