"""The function layer against the source's own engine, in memory."""

from __future__ import annotations

import re
import sqlite3

import pytest

from thalimart.functions.sql_functions import register_functions


@pytest.fixture(scope="module")
def sql(spark):
    assert set(register_functions(spark)) >= {"strftime", "printf_text", "json_each", "split_items", "julianday"}
    return spark.sql


@pytest.fixture(scope="module")
def con():
    return sqlite3.connect(":memory:")


TIMES = ["2018-01-31 10:20:30", "2018-12-31T23:59:59.987", "2018-01-01 02:00:00+05:30", "2016-02-29 00:00:00Z", " 2016-12-31 ", "2017-01-01", "2018-01-07 12:30",
         "12:34", "12:34:56", "2458119.5", "2458119.123456", "2451545", "1721059.5", "5373484.4", "bad", "", "2018-13-01", "2018-01-01 25:00"]


@pytest.mark.parametrize("fmt", ["%Y-%m-%d %H:%M:%S", "%w|%W|%j|%s|%f|%%", "%Y%m%d", "a%", "plain", "%q", "", "é%Y日"])
def test_strftime(spark, sql, con, fmt):
    rows = spark.createDataFrame([(t.strip(),) for t in TIMES], "t string")
    rows.createOrReplaceTempView("time_cells")
    got = {r[0]: r[1] for r in sql(f"SELECT t, strftime('{fmt}', t) FROM time_cells").collect()}
    want = {t.strip(): con.execute("SELECT strftime(?, ?)", (fmt, t.strip())).fetchone()[0] for t in TIMES}
    assert got == want
    assert sql(f"SELECT strftime('{fmt}', CAST(NULL AS STRING))").first()[0] is None


def test_rolled_days_small_numbers_and_spaces(sql):
    assert sql("SELECT datetime('2018-02-30'), datetime('2018'), datetime(' 2018-01-02 '), strftime('%Y', '0')").first()[:] == ("2018-03-02 00:00:00", None, "2018-01-02 00:00:00", None)


@pytest.mark.parametrize("time", TIMES)
def test_julianday_and_unixepoch(sql, con, time):
    time = time.strip()
    got = sql(f"SELECT julianday('{time}'), unixepoch('{time}')").first()
    day, second = con.execute("SELECT julianday(?), CAST(strftime('%s', ?) AS INTEGER)", (time, time)).fetchone()
    assert (got[0] is None) == (day is None) and (day is None or abs(got[0] - day) < 1e-8)
    assert got[1] == second


@pytest.mark.parametrize("call", ["'%s|%s|%s', 'a', NULL, 'c'", "'%s'", "'no'", "'%d|%i|%5.2f%%|%-4s|', '12abc', '-7', '3.14159', 'x'", "'%05d|%s', '42', 'é'",
                                  "'100%% %s %%d', 'x'", "'%s%s', 'a%b', '%s'", "'%d', NULL", "'%.1f', 'x'"])
def test_printf_text(sql, con, call):
    assert sql(f"SELECT printf_text({call})").first()[0] == con.execute(f"SELECT printf({call})").fetchone()[0]


@pytest.mark.parametrize("cell", ["12abc", "", "--", "3.9", "-4.5x", "1e3", ".5", "+7", " 8 "])
def test_lenient_casts(sql, con, cell):
    assert tuple(sql(f"SELECT lenient_int('{cell}'), lenient_real('{cell}')").first()) == con.execute(
        "SELECT CAST(? AS INTEGER), CAST(? AS REAL)", (cell, cell)).fetchone()


def test_json_each(sql, con):
    for doc in ('["a","b"]', "[]", '["", " c ", "d,e"]', '[1, 2.5, null, "x"]'):
        got = [tuple(r) for r in sql(f"SELECT key, value FROM json_each('{doc}')").collect()]
        want = [(k, None if v is None else str(v)) for k, v in con.execute("SELECT key, value FROM json_each(?)", (doc,)).fetchall()]
        assert sorted(got) == sorted(want)
    assert sql("SELECT * FROM json_each(NULL)").collect() == []
    both = sql("""SELECT c, TRIM(j.value) AS v FROM VALUES ('a, b'), ('c') AS t(c) JOIN LATERAL json_each('["' || REPLACE(c, ',', '","') || '"]') j""")
    assert sorted(map(tuple, both.collect())) == [("a, b", "a"), ("a, b", "b"), ("c", "c")]


SPLITTER = """WITH RECURSIVE p AS (
  SELECT c, SUBSTR(c, 1, INSTR(c || ',', ',') - 1) AS head, SUBSTR(c, INSTR(c || ',', ',') + 1) AS rest FROM cells
  UNION ALL SELECT c, SUBSTR(rest, 1, INSTR(rest || ',', ',') - 1), SUBSTR(rest, INSTR(rest || ',', ',') + 1) FROM p WHERE rest <> '')
SELECT c, head FROM p"""


def test_recursive_splitter_and_split_items(spark, sql, con):
    cells = ["A,,B,", "", "a", ",", ",,", "x, y ,z", "é,日"]
    con.execute("CREATE TABLE cells (c TEXT)")
    con.executemany("INSERT INTO cells VALUES (?)", [(c,) for c in cells])
    spark.createDataFrame([(c,) for c in cells], "c string").createOrReplaceTempView("cells")
    want = sorted(con.execute(SPLITTER).fetchall())
    assert sorted(map(tuple, sql(SPLITTER).collect())) == want
    assert sorted(map(tuple, sql("SELECT c, item FROM cells, LATERAL split_items(c, ',')").collect())) == want
    assert [r[0] for r in sql("SELECT item FROM split_items('a.b|c.d', '.b|')").collect()] == ["a", "c.d"]


def test_iso_formats_are_cut_from_the_times_text(spark):
    register_functions(spark)
    values = ["2019-03-04 05:06:07.891", "0000-01-02", "9999-12-31 23:30:00-01:00", "0000-01-01 00:10:00+01:00", "2019-02-30", "2458546.5", "12:13:14", "x", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for n in range(2, len("%Y-%m-%d %H:%M:%S") + 1):
        fmt = "%Y-%m-%d %H:%M:%S"[:n]
        # a format in a column, or with a text before it, is put together piece by piece
        rows = df.selectExpr(f"strftime('{fmt}', v) AS a", f"substr(strftime('/{fmt}', v), 2) AS b").collect()
        assert [r.a for r in rows] == [r.b for r in rows], fmt
    plan = df.selectExpr("strftime('%Y-%m', v)", "datetime(v)")._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"substr(?:ing)?\(cast\(lambda t", plan)) == 2, plan
