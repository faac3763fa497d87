"""Continuous incremental load with Structured Streaming.

New staged order files (CSV, the staging layout) arriving in a folder are
read as a stream; each micro-batch is merged into the written warehouse by
``foreachBatch``:

* new users, restaurants, locations and days of the batch are inserted into the
  dimensions (known natural keys are ignored);
* orders go through the same insert-or-ignore as a batch load
  (``plans.incremental.append_batch``); the new rows are computed and written
  once, under the scratch folder, and appended from there;
* orders that break a rule go to the batch's quarantine under ``loads`` with their
  reason; those whose user or restaurant is unknown are tried again;
* the stored aggregates (``plans.states``), if the warehouse keeps them, take in the
  new orders;
* new keys start after the largest key of the fact, read from the footers of
  its one key column, so a batch that stopped half way leaves no mark behind.

Each append is one Spark write job (files become visible at job commit), and
the anti-join on ``order_nk`` makes a replayed micro-batch a no-op, so a
batch retried after a failure does not duplicate orders. Progress is kept in
the stream's checkpoint location (a shared folder on a cluster).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import etl, incremental, rules, states
from ..plans.warehouse import complete_folders, open_warehouse, remove, written_under
from ..sources.staging import ORDERS_COLS, ORDERS_CSV, Staging, _text_schema


def late_orders(spark: SparkSession, root: str) -> DataFrame | None:
    """Orders that wait for a dimension row: a part of the newest quarantine."""
    done = complete_folders(spark, f"{root}/loads")
    return rules.waiting(rules.quarantine(spark, f"{root}/loads/{done[-1]}")) if done else None


def merge_batch(spark: SparkSession, root: str, batch: DataFrame, users: DataFrame | None = None,
                restaurants: DataFrame | None = None, locations: DataFrame | None = None) -> None:
    """Merge one batch of staged orders, and of staged dimension rows if given,
    into the warehouse at ``root``."""
    wh = open_warehouse(spark, root)
    waiting = late_orders(spark, root)
    orders = batch.select(*[F.col(c).cast("string") for c in ORDERS_CSV])
    if waiting is not None:
        orders = orders.unionByName(waiting.select(*ORDERS_CSV))
    # the batch's own order decides which of two equal keys is first; cells are
    # equal then, so any total order will do
    orders = written_under(wh.scratch, etl.parsed_orders(orders.withColumn("ingest_seq", F.lit(0).cast("long"))), "orders")

    def rows(df: DataFrame | None, like: DataFrame) -> DataFrame:
        return like.limit(0) if df is None else df
    staged = Staging(users=rows(users, wh.staging.users), restaurants=rows(restaurants, wh.staging.restaurants),
                     locations=rows(locations, wh.staging.locations), orders=orders, parsed=orders)
    for name, added in incremental.dimension_additions(wh, staged, wh.scratch).items():
        written_under(wh.scratch, added, name).write.mode("append").parquet(f"{root}/{name}")
    wh = open_warehouse(spark, root)
    if locations is not None:
        repatch(spark, root)
        wh = open_warehouse(spark, root)
    load = f"{root}/loads/{time.time_ns():020d}"
    rules.checked_load(orders, wh, load)
    added = written_under(wh.scratch, incremental.append_loaded(wh.orders, rules.accepted(spark, load), wh, wh.scratch), "new-orders")
    added.write.mode("append").partitionBy("year").parquet(f"{root}/order_wide")
    remove(spark, f"{load}/reason={rules.ACCEPTED}")  # they are in the fact now
    remove(spark, wh.scratch)
    if states.kept(spark, root):
        states.update(spark, root, open_warehouse(spark, root).orders)


def repatch(spark: SparkSession, root: str) -> None:
    """Gives facts without a location the one that matches now, rewriting only
    the years that hold such facts."""
    wh = open_warehouse(spark, root)
    base = wh.orders.drop("loc_country", "loc_state", "loc_city")
    years = [r[0] for r in base.where(F.col("location_key").isNull()).select("year").distinct().collect()]
    if not years:
        return
    patched = incremental.patch_locations(base.where(F.col("year").isin(years)), wh.dim_restaurant, wh.dim_location)
    wide = patched.join(etl.location_attributes(wh.dim_location), "location_key", "left").select(*wh.orders.columns)
    written_under(wh.scratch, wide, "patched").write.mode("overwrite").partitionBy("year") \
        .option("partitionOverwriteMode", "dynamic").parquet(f"{root}/order_wide")


def start_incremental_load(spark: SparkSession, orders_dir: str, root: str,
                           checkpoint_location: str, available_now: bool = True
                           ) -> StreamingQuery:
    """Start the stream over ``orders_dir`` (CSV with the staging header)."""
    md = F.col("_metadata")
    stream = (spark.readStream.option("header", "true").schema(_text_schema(ORDERS_CSV))
              .csv(orders_dir)
              .select(*ORDERS_CSV, md.getField("file_path").alias("_file"),
                      md.getField("file_block_start").alias("_block")))

    def apply(batch: DataFrame, batch_id: int) -> None:
        # load order: micro-batch, file, split, row in split (row ids are only
        # available on the static micro-batch frame)
        seq = F.struct(F.lit(batch_id).cast("long").alias("batch"), F.col("_file").alias("file"),
                       F.col("_block").alias("block"),
                       F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
                       .alias("row"))
        merge_batch(spark, root, batch.withColumn("ingest_seq", seq).select(*ORDERS_COLS))

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation",
                                                           checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start()
