"""SparkSession defaults and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: AQE re-plans joins at runtime (broadcast when
# a side turns out small, skew-split hot partitions), and partitions are
# coalesced after shuffles so small inputs do not pay for 200 empty tasks.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "thalimart", extra: dict | None = None) -> SparkSession:
    """A session with the settings above. Master, memory and shuffle partitions
    are set only if given (tests, bench); else ``spark-submit`` and the cluster
    decide."""
    b = SparkSession.builder.appName(app)
    conf = dict(DEFAULT_CONF)
    if master:
        b = b.master(master)
        conf["spark.driver.memory"] = os.environ.get("THALIMART_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """True when driver and executors are one process on one machine."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or a checkpoint dir already
    set on the context). When neither is set, a local master gets a fresh
    local folder (tests, bench); any other master is refused, because every
    executor would write to its own disk and later reads would miss files.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    d = d or sc.getCheckpointDir()
    if not d:
        if not is_local(spark):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="thalimart-ckpt-"))
        d = sc.getCheckpointDir()
    return d.rstrip("/")


def written_under(scratch: str, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written once under the scratch folder and read back."""
    path = f"{scratch}/{name}-{uuid.uuid4().hex}"
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
