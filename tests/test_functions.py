"""Column helpers: lenient casts, rounding, buckets."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from thalimart.functions import buckets as B
from thalimart.functions.lenient import iso_timestamp, lenient_double, lenient_int
from thalimart.functions.numeric import money_round, percent


def _one_col(spark, values, name="v"):
    schema = StructType([StructField(name, StringType(), True)])
    return spark.createDataFrame([(v,) for v in values], schema)


def test_lenient_int_prefix_rules(spark):
    # blank -> 0, '12abc' -> 12, '3.9' -> 3, junk -> 0, NULL stays NULL (M26)
    df = _one_col(spark, ["", "12abc", "3.9", "--", None, " 7 ", "-4x"])
    got = [r[0] for r in df.select(lenient_int(F.col("v"))).collect()]
    assert got == [0, 12, 3, 0, None, 7, -4]


def test_lenient_double_prefix_rules(spark):
    df = _one_col(spark, ["--", "4.5", "", None, "1e2x", ".5"])
    got = [r[0] for r in df.select(lenient_double(F.col("v"))).collect()]
    assert got == [0.0, 4.5, 0.0, None, 100.0, 0.5]


def test_iso_timestamp_guard(spark):
    df = _one_col(spark, ["2024-01-07 10:00:00", "2018", "bad", "2018-02-30 00:00:00",
                          "2024-01-07", None])
    got = [r[0] for r in df.select(iso_timestamp(F.col("v"))).collect()]
    assert [g is not None for g in got] == [True, False, False, True, True, False]


def test_money_round_half_up_through_decimal(spark):
    df = spark.createDataFrame([(74596.275,), (0.125,), (-2.345,), (None,)], "v double")
    got = [r[0] for r in df.select(money_round(F.col("v"), 2)).collect()]
    assert got == [74596.28, 0.13, -2.35, None]


def test_percent_guards_zero(spark):
    df = spark.createDataFrame([(1, 3), (1, 0)], "n long, d long")
    got = [r[0] for r in df.select(percent(F.col("n"), F.col("d"))).collect()]
    assert got == [33.33, None]


@pytest.mark.parametrize("raw,group,order", [
    ("No Income", "No Income", 9),            # M1: 'No Income' is not 'None'
    (None, "Unknown", 9),                      # M2
    ("weird", "Unknown", 9),
    ("Below Rs.10000", "Below 10k", 1),
    ("10001 to 25000", "10k-25k", 2),
    ("25001 to 50000", "25k-50k", 3),
    ("More than 50000", "50k+", 4),
])
def test_income_buckets(spark, raw, group, order):
    df = _one_col(spark, [raw]).select(B.income_group(F.col("v")).alias("g"))
    row = df.select("g", B.income_group_order(F.col("g"))).first()
    assert (row[0], row[1]) == (group, order)


def test_education_buckets(spark):
    # M3: case-sensitive Ph.D
    df = _one_col(spark, ["PH.D", "Ph.D", "SCHOOL", None, "Post Graduate"])
    g = df.select(B.education_group(F.col("v")).alias("g"))
    got = [(r[0], r[1]) for r in g.select("g", B.education_group_order(F.col("g"))).collect()]
    assert got == [("Unknown", 0), ("Doctoral", 3), ("Basic Education", 1), ("Unknown", 0),
                   ("Higher Education", 2)]


def test_family_income_level_rating_tier(spark):
    fam = spark.createDataFrame([(0,), (1,), (2,), (3,), (4,), (None,)], "s int")
    got = [r[0] for r in fam.select(B.family_group(F.col("s"))).collect()]
    assert got == ["4+ members (>=2 children)", "1 member", "2 members", "3 members (one child)",
                   "4+ members (>=2 children)", "Unknown"]        # M20
    lvl = _one_col(spark, ["No Income", "Below 10k", "25k-50k", "50k+", "Unknown"])
    assert [r[0] for r in lvl.select(B.income_level(F.col("v"))).collect()] == \
        ["Unknown", "Low", "Middle", "High", "Unknown"]
    rt = spark.createDataFrame([(4.5,), (4.0,), (3.5,), (3.0,), (0.0,), (None,)], "r double")
    assert [r[0] for r in rt.select(B.rating_tier(F.col("r"))).collect()] == \
        ["Excellent (4.5+)", "Very Good (4.0-4.4)", "Good (3.5-3.9)", "Average (3.0-3.4)",
         "Below Average (<3.0)", "Below Average (<3.0)"]          # M19


def test_loyalty_and_holidays(spark):
    n = spark.createDataFrame([(1,), (2,), (5,), (6,), (15,), (16,)], "n long")
    assert [r[0] for r in n.select(B.loyalty_segment(F.col("n"))).collect()] == \
        ["One-time", "Occasional", "Occasional", "Regular", "Regular", "Frequent"]   # M23
    md = spark.createDataFrame([(12, 25), (12, 31), (12, 26), (2, 14)], "m int, d int")
    assert [r[0] for r in md.select(B.is_holiday(F.col("m"), F.col("d"))).collect()] == \
        [1, 1, 0, 1]                                               # M25


def test_timestamp_text_ignores_session_time_zone(spark):
    # 02:30 on 2017-03-12 does not exist in America/Los_Angeles; the text of a
    # TIMESTAMP_NTZ must not move (date_format would print 03:30)
    from thalimart.functions.lenient import date_text, ntz_text
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.sql("SELECT timestamp_ntz'2017-03-12 02:30:05' AS t")
        row = df.select(ntz_text(F.col("t")).alias("a"),
                        date_text(F.to_date(F.col("t"))).alias("b"),
                        iso_timestamp(F.lit("2017-03-12 02:30:05")).alias("c")).first()
        assert (row.a, row.b) == ("2017-03-12 02:30:05", "2017-03-12")
        assert row.c.hour == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dates_roll_and_apply_their_zone(spark):
    cells = {"2018-02-30": "2018-03-02 00:00:00", "2018-02-29 10:00:00": "2018-03-01 10:00:00", "2020-02-29": "2020-02-29 00:00:00",
             "2018-04-31 23:59:59": "2018-05-01 23:59:59", "2018-01-01 02:00:00+05:30": "2017-12-31 20:30:00",
             "2018-01-01 02:00:00 -03:00": "2018-01-01 05:00:00", "2018-01-01 02:00:00Z": "2018-01-01 02:00:00",
             "2018-01-01T07:08:09": "2018-01-01 07:08:09", "2018-01-32": None, "2018-13-01": None, "2018-01-00": None,
             "bad-date": None, "2018": None, "2018-01-01 25:00:00": None, "2018-01-01 10:30": "2018-01-01 10:30:00"}
    df = spark.createDataFrame([(k,) for k in cells], "d string")
    from thalimart.functions.lenient import ntz_text
    got = {r.d: r.t for r in df.select("d", ntz_text(iso_timestamp(F.col("d"))).alias("t")).collect()}
    assert got == cells


def test_wide_sum_is_exact_beyond_38_digits(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    from thalimart.functions.numeric import wide_sum
    groups = {"much": ["9e32"] * 40 + ["0.00001"], "less": ["-9e32"] * 40 + ["-0.00001", "3"], "none": [None],
              "cents": ["0.1", "-0.30001", "1e15"], "minus": ["-5", "4.99999"], "zero": ["7", "-7"], "borrow": ["-1e15", "0.5"]}
    rows = [(k, v) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "k string, v string").select("k", F.col("v").cast("double").cast("decimal(38,5)").alias("d"))
    exact = {k: [r.d for r in df.where(F.col("k") == k).collect()] for k in groups}
    got = {r.k: r.s for r in df.groupBy("k").agg(wide_sum(F.col("d")).alias("s")).collect()}
    import decimal
    with decimal.localcontext(prec=80):
        assert got == {k: None if v == [None] else float(sum(v, Decimal(0))) for k, v in exact.items()}


def test_csv_roundtrip_sums_huge_amounts(spark, tmp_path):
    from types import SimpleNamespace

    from thalimart.plans.roundtrip import staging_through_csv
    orders = spark.createDataFrame([(i, 1, "2018-05-05 10:00:00", 1, 9e32, "INR") for i in range(4)],
                                   "user_id long, r_id long, order_date string, sales_qty int, sales_amount double, currency string")
    row = staging_through_csv(SimpleNamespace(staging=SimpleNamespace(orders=orders), scratch=str(tmp_path))).first()
    assert (row.n_rows, row.amount) == (4, 3.6e33)
