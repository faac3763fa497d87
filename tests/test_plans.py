"""Physical-plan assertions: the plans we want at scale, not just the rows."""

from __future__ import annotations

import pytest

from thalimart.plans.catalog import QUERIES
from thalimart.plans.warehouse import warehouse_for

SF = "/root/testdata/sf0.001"
STATIC_KEYS = sorted(k for k in QUERIES if k != "etl_fact_incremental")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse_for(spark, SF)


@pytest.mark.parametrize("key", STATIC_KEYS)
def test_no_pairwise_joins(wh, key):
    plan = _plan(QUERIES[key](wh))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_festival_prunes_year_partitions(wh):
    plan = _plan(QUERIES["rq2_2_festival_top"](wh))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans
    for scan in scans:
        part = scan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
        assert "year" in part and "2017" in part
        assert "In(month, [10,11])" in scan


def test_scans_read_only_needed_columns(wh):
    plan = _plan(QUERIES["bi1_monthly_revenue"](wh))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "cuisine" not in scan and "order_nk" not in scan


def test_customer_grain_before_join(wh):
    # RQ1.2: the fact is aggregated per customer before meeting dim_customer
    plan = _plan(QUERIES["rq1_2_income_frequency"](wh))
    join_at = min(i for i, line in enumerate(plan.splitlines()) if "Join" in line)
    below = "\n".join(plan.splitlines()[join_at:])
    assert "partial_count(order_key" in below


def test_location_match_is_an_equi_join(spark):
    from thalimart.operators.substring_match import first_substring_match
    t = spark.createDataFrame([("Baner,PUNE",)], "city string")
    p = spark.createDataFrame([("Pune", 1)], "city string, k long")
    plan = _plan(first_substring_match(t, "city", p, "city", "k"))
    assert "BroadcastNestedLoopJoin" not in plan and "Cartesian" not in plan


def test_existing_facts_are_pruned_by_the_batch(wh):
    from thalimart.plans.incremental import existing_keys
    batch = wh.orders.where("year = 2016 AND month = 3").select("date_key")
    scan = [x for x in _plan(existing_keys(wh.orders, batch)).splitlines() if "FileScan parquet" in x][0]
    part = scan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "2016" in part and "GreaterThanOrEqual(date_key,201603" in scan and "cuisine" not in scan


def test_top_n_limits_groups_before_the_shuffle(wh):
    assert "WindowGroupLimit" in _plan(QUERIES["rq1_4_cuisine_by_income"](wh))


def test_checks_scan_the_fact_once(wh):
    # the fact is the only table whose scan carries the partition column
    for key in ("qa_fk_orphans", "dq_unique_keys"):
        scans = [x for x in _plan(QUERIES[key](wh)).splitlines() if "FileScan parquet" in x]
        assert len([x for x in scans if ",year#" in x.split("]")[0]]) == 1, key


def test_machine_local_scratch_is_refused_on_a_cluster():
    from types import SimpleNamespace

    from thalimart.session import checkpoint_root
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None,
                         getConf=lambda: SimpleNamespace(get=lambda k: None))
    with pytest.raises(RuntimeError):
        checkpoint_root(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d)))


def test_build_leaves_no_scratch_tables(wh):
    spark = wh.orders.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(wh.root)
    names = {s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)}
    assert names - {"_tmp"} == {"dim_customer", "dim_date", "dim_location", "dim_restaurant", "order_wide",
                                "stg_locations", "stg_orders", "stg_restaurants", "stg_users"}


@pytest.mark.parametrize("key, tables", [("dq_duplicate_users", {"stg_users"}), ("etl_dim_customer", {"stg_users", "dim_customer"}),
                                         ("sql_julian_days", {"stg_orders"}), ("sql_order_keys", {"stg_orders"})])
def test_a_query_builds_only_the_tables_it_reads(spark, tmp_path, monkeypatch, key, tables):
    from thalimart.plans import warehouse
    from thalimart.plans.extended import EXTENDED
    monkeypatch.setattr(warehouse, "_BUILT", {})
    monkeypatch.setattr(warehouse, "checkpoint_root", lambda _: str(tmp_path))
    (QUERIES | EXTENDED)[key](warehouse_for(spark, SF)).count()
    found = {p.name for p in next(tmp_path.iterdir()).iterdir() if p.is_dir() and p.name != "_tmp"}
    assert found == tables


def test_orders_are_shuffled_as_narrow_cells(wh):
    from thalimart.plans import etl
    plan = _plan(etl.load_fact(wh.staging.order_cells, wh.dim_customer, wh.dim_restaurant))
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and not any("order_nk" in line for line in dealt)


def test_one_shuffle_dedups_and_numbers(spark, wh, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from thalimart.plans import etl
    seen = []
    monkeypatch.setattr(etl, "number_rows", lambda df, name, *_: seen.append(_plan(df)) or df.withColumn(name, F.lit(1)))
    cells = etl.resolved_orders(wh.staging.order_cells, wh.dim_customer, wh.dim_restaurant)
    etl.number_first_orders(cells)
    monkeypatch.undo()
    above = seen[0][:seen[0].index("Join")]
    assert above.count("Exchange") == 1 and "rangepartitioning" in above
    # a hot key, staged over and over in many partitions, and copies that differ in their cells
    many = cells.limit(40).crossJoin(spark.range(300).repartition(7)).withColumn("ingest_seq", F.col("id")).drop("id")
    many = many.withColumn("p_qty", F.col("p_qty") + F.col("ingest_seq"))
    got = etl.number_first_orders(many, 5, str(tmp_path)).orderBy("order_key").collect()
    want = etl.with_fact_cells(many.where("ingest_seq = 0").distinct()).collect()
    assert [r.order_key for r in got] == list(range(6, 6 + len(want)))
    assert [(r.order_nk, r.sales_qty) for r in got] == sorted((r.order_nk, r.sales_qty) for r in want)
