"""Dense surrogate keys 1..n in a total order, without a single-task window.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
Instead:

1. ``orderBy`` range-partitions and sorts the rows (one shuffle, sampled
   bounds, any number of tasks; AQE may merge neighbouring ranges, which
   keeps the order);
2. ``monotonically_increasing_id`` numbers rows inside each sorted partition
   (partition index in the upper 31 bits, position in the lower 33);
3. that tagged frame is written once as a Parquet table under the shared
   checkpoint folder and read back, so the ids are computed once and stored -
   a recomputation after a lost executor, or a second read with fewer
   columns, sees the same ids (recomputing the sort could group rows into
   partitions differently). One write job; ``DataFrame.checkpoint`` would
   compute the input twice (count, then the checkpoint write);
4. rows per partition are counted - one row per partition - and turned into
   running offsets by a window over that tiny table;
5. the offsets (bounded by the partition count, so safe to broadcast) are
   joined back and added to the in-partition position.

The tagged table goes under ``scratch`` (by default the shared checkpoint
folder); a caller that writes the result removes it afterwards.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

_ID = "_dk_id"
_PART = "_dk_part"
_N = "_dk_n"
_OFF = "_dk_off"
_POS_BITS = 33


def with_dense_key(df: DataFrame, order_by: Sequence[Column], name: str,
                   scratch: str | None = None, after: int = 0) -> DataFrame:
    """Add ``name`` (bigint, ``after`` + 1 .. n) as the first column, following
    ``order_by``, which must be a total order over the rows for the numbering to
    be reproducible.

    Runs the sort and the write of the tagged rows eagerly."""
    return number_rows(df.orderBy(*order_by), name, scratch, after)


def number_rows(df: DataFrame, name: str, scratch: str | None = None, after: int = 0) -> DataFrame:
    """``with_dense_key`` for rows whose partitions are ascending ranges and sorted."""
    spark = df.sparkSession
    path = f"{scratch or checkpoint_root(spark)}/thalimart-keys-{name}-{uuid.uuid4().hex}"
    (df.withColumn(_ID, F.monotonically_increasing_id())
     .write.mode("overwrite").parquet(path))
    tagged = spark.read.parquet(path)
    part = F.shiftright(F.col(_ID), _POS_BITS)
    counts = tagged.groupBy(part.alias(_PART)).agg(F.count(F.lit(1)).alias(_N))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PART, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF))
    pos = F.col(_ID).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    keyed = (tagged.join(F.broadcast(offsets), part == F.col(_PART))
             .withColumn(name, (F.col(_OFF) + pos + F.lit(1 + after)).cast("bigint"))
             .drop(_ID, _PART, _OFF))
    return keyed.select(name, *df.columns)
