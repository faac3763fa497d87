"""Headers in any order, faulty lines, line breaks in cells."""

from __future__ import annotations

import pytest
from test_etl_fixtures import LOCATIONS, ORDERS, RESTAURANTS, USERS

from thalimart.sources.checked_csv import cells_of, read_checked_csv, read_checked_staging
from thalimart.sources.staging import LOCATION_CSV, RESTAURANT_CSV, USERS_CSV, read_csv_staging
from pyspark.sql import functions as F


def test_columns_by_name_extra_and_missing(spark, tmp_path):
    (tmp_path / "r.csv").write_text('CITY,note,ID, Rating \nPune,x,7,4.5\n"Baner,PUNE",y,8,\n')
    got = read_checked_csv(spark, str(tmp_path / "r.csv"), RESTAURANT_CSV)
    assert [(r.id, r.name, r.city, r.rating, r.cuisine, r.bad_line) for r in got.orderBy("ingest_seq").collect()] == [
        ("7", None, "Pune", "4.5", None, None), ("8", None, "Baner,PUNE", None, None, None)]


def test_faulty_lines_are_kept_and_counted(spark, tmp_path):
    (tmp_path / "l.csv").write_text('Country,State,City\nIndia,MH,Pune\nIndia,MH\nIndia,MH,"A,B",extra,more\n\nIndia,,Mumbai\n')
    got = read_checked_csv(spark, str(tmp_path / "l.csv"), LOCATION_CSV).orderBy("ingest_seq").collect()
    assert [(r.country, r.state, r.city) for r in got] == [("India", "MH", "Pune"), ("India", "MH", None), ("India", "MH", "A,B"), ("India", None, "Mumbai")]
    assert [r.bad_line for r in got] == [None, "India,MH", 'India,MH,"A,B",extra,more', None]
    df = spark.createDataFrame([(r.bad_line,) for r in got if r.bad_line], "x string")
    assert sorted(r[0] for r in df.select(cells_of(F.col("x"))).collect()) == [2, 5]


def test_line_breaks_in_cells(spark, tmp_path):
    (tmp_path / "u.csv").write_text(USERS.splitlines()[0] + '\n1,"two\nlines, ""quoted""",a@x,30,F,1,No Income,Graduate\n2,B,b@x,31,M,2,,\n')
    got = read_checked_csv(spark, str(tmp_path / "u.csv"), USERS_CSV, multi_line=True).orderBy("user_id").collect()
    assert [(r.user_id, r.name, r.bad_line) for r in got] == [("1", 'two\nlines, "quoted"', None), ("2", "B", None)]


def test_another_header_stops_the_read(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "a.csv").write_text("Country,State,City\nIndia,MH,Pune\n")
    (tmp_path / "l" / "b.csv").write_text("City,State,Country\nMumbai,MH,India\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_checked_csv(spark, str(tmp_path / "l"), LOCATION_CSV).collect()


def test_sound_files_read_as_before(spark, tmp_path):
    paths = []
    for name, text in (("users", USERS), ("restaurants", RESTAURANTS), ("orders", ORDERS), ("locations", LOCATIONS)):
        (tmp_path / f"{name}.csv").write_text(text)
        paths.append(str(tmp_path / f"{name}.csv"))
    old, (new, bad) = read_csv_staging(spark, *paths), read_checked_staging(spark, *paths)
    for name in ("users", "restaurants", "orders", "locations"):
        a, b = getattr(old, name).drop("ingest_seq"), getattr(new, name).drop("ingest_seq")
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert bad.collect() == []
    with open(paths[3], "a") as f:
        f.write("India,MH,Pune,surplus\n")
    found = read_checked_staging(spark, *paths)[1].collect()
    assert [tuple(r) for r in found] == [("locations", 4, ["India", "MH", "Pune"], "India,MH,Pune,surplus")]
