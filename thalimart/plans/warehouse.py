"""The written warehouse: build once, then every query reads Parquet.

Tables are written in dependency order and read back before the next step
uses them, so each step starts from files (lineage is cut; a lost executor
recomputes one step, not the whole ETL). The location is a folder under the
cluster's shared checkpoint directory, never a machine-local one.

Intermediate tables go under ``<root>/_tmp`` and are removed when the build
ends.

Layout: dimensions as plain Parquet; the wide order fact partitioned by
``year`` so year filters prune files (and dynamic partition pruning applies
when a filtered date table is joined on the year).
"""

from __future__ import annotations

import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, written_under
from ..sources.staging import ORDERS_COLS, Staging
from ..sources.testdata import adapter_staging
from . import etl


@dataclass
class Warehouse:
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_restaurant: DataFrame
    dim_location: DataFrame
    orders: DataFrame          # wide fact: fact columns + dimension attributes
    staging: Staging
    root: str | None = None

    @property
    def spark(self) -> SparkSession:
        return self.dim_date.sparkSession

    @property
    def scratch(self) -> str:
        """Where intermediate tables of later loads go."""
        return f"{self.root}/_tmp"

    @property
    def fact(self) -> DataFrame:
        return self.orders.select(*etl.FACT_COLS)

    @property
    def located_orders(self) -> DataFrame:
        """Orders joined to ``dim_location`` (inner): orders without a
        matching city drop out, as in the source queries."""
        return self.orders.where(self.orders.location_key.isNotNull())


def _write(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the warehouse through Spark's file systems."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under ``path`` whose write job has ended, sorted."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path(path)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(jvm_path(path)) if s.isDirectory()]
    return sorted(n for n in names if fs.exists(jvm_path(f"{path}/{n}/_SUCCESS")))


def _by_month(wide: DataFrame) -> DataFrame:
    """The partitioned writer sorts each task's rows by year anyway; extending
    that local sort to month and day gives every row group tight month/date
    ranges, so month filters skip row groups by their statistics."""
    return wide.sortWithinPartitions("year", "month", "date_key")


class _Phases:
    """Optional wall-clock split of a build (seconds per phase)."""

    def __init__(self, into: dict[str, float] | None):
        self.into, self.t = into, time.perf_counter()

    def mark(self, name: str) -> None:
        now = time.perf_counter()
        if self.into is not None:
            self.into[name] = round(now - self.t, 3)
        self.t = now


def _in_parallel(tasks: dict) -> None:
    """Run independent write jobs from driver threads (Spark schedules
    concurrent jobs); re-raise the first failure."""
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        for fut in [pool.submit(fn) for fn in tasks.values()]:
            fut.result()


def build_warehouse(spark: SparkSession, staging: Staging, root: str,
                    phases: dict[str, float] | None = None) -> Warehouse:
    """Run the ETL and write every table under ``root``.

    The staging tables are written first: the order staging feeds both
    ``dim_date`` and the fact, and is computed once instead of twice."""
    clock = _Phases(phases)
    scratch = f"{root}/_tmp"
    staging = stage(spark, staging, root)
    clock.mark("staging")
    builders = {"dim_date": lambda: etl.build_dim_date(staging.order_cells),
                "dim_customer": lambda: etl.build_dim_customer(staging.users, scratch),
                "dim_restaurant": lambda: etl.build_dim_restaurant(staging.restaurants, scratch),
                "dim_location": lambda: etl.build_dim_location(staging.locations, scratch)}
    # the four dimensions are independent: their jobs run concurrently
    _in_parallel({name: (lambda n=name: _write(builders[n](), f"{root}/{n}"))
                  for name in builders})
    out = {name: spark.read.parquet(f"{root}/{name}") for name in builders}
    clock.mark("dimensions")
    wide = etl.build_fact_wide(staging.order_cells, out["dim_customer"], out["dim_restaurant"],
                               out["dim_location"], scratch)
    _write(_by_month(wide), f"{root}/order_wide", partition_by="year")
    clock.mark("fact")
    remove(spark, scratch)
    wh = open_warehouse(spark, root)
    clock.mark("finish")
    return wh


STAGING_TABLES = ("users", "restaurants", "orders", "locations")


def stage(spark: SparkSession, staging: Staging, root: str) -> Staging:
    """Write the staging tables under ``root``, orders with their parsed cells, and
    return readers over them."""
    tables = {n: getattr(staging, n) for n in STAGING_TABLES} | {"orders": etl.parsed_orders(staging.order_cells)}
    _in_parallel({name: (lambda n=name: _write(tables[n], f"{root}/stg_{n}")) for name in tables})
    return open_staging(spark, root)


def open_staging(spark: SparkSession, root: str) -> Staging:
    tables = {n: spark.read.parquet(f"{root}/stg_{n}") for n in STAGING_TABLES}
    return Staging(**tables | {"orders": tables["orders"].select(*ORDERS_COLS)}, parsed=tables["orders"])


def open_warehouse(spark: SparkSession, root: str) -> Warehouse:
    r = spark.read
    return Warehouse(
        dim_date=r.parquet(f"{root}/dim_date"),
        dim_customer=r.parquet(f"{root}/dim_customer"),
        dim_restaurant=r.parquet(f"{root}/dim_restaurant"),
        dim_location=r.parquet(f"{root}/dim_location"),
        orders=r.schema(etl.WIDE_SCHEMA).parquet(f"{root}/order_wide"),
        staging=open_staging(spark, root),
        root=root,
    )


class _OnDemand:
    """Tables under one folder, each written when it is first asked for."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._folder = spark, root
        self._found: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    __repr__ = object.__repr__    # a dataclass's would read, and so build, every table

    def _table(self, name: str, build, partition_by: str | None = None, schema: str | None = None) -> DataFrame:
        """The written table; ``build`` gets a scratch folder, removed after the write."""
        with self._lock:
            if name not in self._found:
                scratch = f"{self._folder}/_tmp/build-{name}"
                _write(build(scratch), f"{self._folder}/{name}", partition_by)
                remove(self._spark, scratch)
                reader = self._spark.read.schema(schema) if schema else self._spark.read
                self._found[name] = reader.parquet(f"{self._folder}/{name}")
            return self._found[name]


class StagingOnDemand(_OnDemand, Staging):
    """``stage`` table by table."""

    def __init__(self, spark: SparkSession, source: Staging, root: str):
        super().__init__(spark, root)
        self._source = source

    users = property(lambda self: self._table("stg_users", lambda _: self._source.users))
    restaurants = property(lambda self: self._table("stg_restaurants", lambda _: self._source.restaurants))
    locations = property(lambda self: self._table("stg_locations", lambda _: self._source.locations))
    parsed = property(lambda self: self._table("stg_orders", lambda _: etl.parsed_orders(self._source.order_cells)))
    orders = property(lambda self: self.parsed.select(*ORDERS_COLS))


class WarehouseOnDemand(_OnDemand, Warehouse):
    """``build_warehouse`` table by table: a query pays for the tables it reads,
    and for those that they are made of."""

    def __init__(self, spark: SparkSession, source: Staging, root: str):
        super().__init__(spark, root)
        self.staging = StagingOnDemand(spark, source, root)

    dim_date = property(lambda self: self._table("dim_date", lambda _: etl.build_dim_date(self.staging.order_cells)))
    dim_customer = property(lambda self: self._table("dim_customer", lambda s: etl.build_dim_customer(self.staging.users, s)))
    dim_restaurant = property(lambda self: self._table("dim_restaurant", lambda s: etl.build_dim_restaurant(self.staging.restaurants, s)))
    dim_location = property(lambda self: self._table("dim_location", lambda s: etl.build_dim_location(self.staging.locations, s)))
    spark = property(lambda self: self._spark)
    scratch = property(lambda self: f"{self._folder}/_tmp")

    @property
    def orders(self) -> DataFrame:
        return self._table("order_wide", lambda s: _by_month(etl.build_fact_wide(
            self.staging.order_cells, self.dim_customer, self.dim_restaurant, self.dim_location, s)), "year", etl.WIDE_SCHEMA)

    @property
    def root(self) -> str:
        """The folder of the whole warehouse: tables not asked for yet are built."""
        for name in ("users", "restaurants", "locations", "parsed"):
            getattr(self.staging, name)
        for name in ("dim_date", "dim_customer", "dim_restaurant", "dim_location", "orders"):
            getattr(self, name)
        return self._folder


_LOCK = threading.Lock()
_BUILT: dict[tuple[str, str], Warehouse] = {}


def warehouse_for(spark: SparkSession, sf_dir: str,
                  phases: dict[str, float] | None = None) -> Warehouse:
    """Warehouse of the test tables in ``sf_dir``, written once per Spark
    application; later calls reuse the written tables and the frames. Each table
    is built when a query first asks for it; with ``phases`` all are built at once."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        wh = _BUILT.get(key)
        if wh is None:
            t = time.perf_counter()
            staging = adapter_staging(spark, sf_dir)
            if phases is not None:
                phases["adapter"] = round(time.perf_counter() - t, 3)
            root = f"{checkpoint_root(spark)}/thalimart-wh-{uuid.uuid4().hex}"
            wh = WarehouseOnDemand(spark, staging, root) if phases is None else build_warehouse(spark, staging, root, phases=phases)
            _BUILT[key] = wh
    return wh
