"""Distributed LSD radix sort of narrow rows.

The rows are sorted by a list of integer keys, the last the most significant. A
key is cut into digits of ``DIGIT_BITS`` bits; each digit is one stable
counting-sort pass, from the least significant digit of the first key to the
most significant one of the last:

1. the rows stand in blocks of ``1 << BLOCK_BITS`` consecutive places, and every
   block counts its digits;
2. prefix sums over the counts, ordered by digit, then block, give the place at
   which a block's rows of a digit begin;
3. a row's destination is that place plus its position among the rows of its
   block and digit. Destinations are the places of the next pass.

No task sees more than a block's rows of one key: a digit shared by all rows is
spread over all blocks, so hot keys need no salting. The prefix sums run over
counts in two levels (digit totals; runs of ``1 << BLOCK_BITS`` blocks; blocks in
a run), so no window holds more than the number of runs. Every pass writes its
narrow rows to the shared folder: a lost executor repeats a part of one pass, and
places are never computed twice.

Defined results: rows equal in every key keep the order of ``at``; nulls sort
last; digits in which all rows agree cost no pass; an empty table has no places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

DIGIT_BITS = 8
BLOCK_BITS = 10


def _passes(rows: DataFrame, keys: list[str]) -> tuple[int, list[tuple[str, Column, int]]]:
    """How many rows there are, and (key, its value from 0, bits) of every key;
    nulls become a key of one bit above their own."""
    ends = rows.agg(F.count(F.lit(1)), *(f(k) for k in keys for f in (F.min, F.max, F.count))).first()
    total, out = ends[0], []
    for i, k in enumerate(keys):
        least, most, some = ends[1 + 3 * i:4 + 3 * i]
        if some:
            c = F.col(k)
            # beyond 63 bits the sign bit is flipped instead: the order of unsigned numbers
            value = c - F.lit(least) if most - least < 1 << 63 else c.bitwiseXOR(F.lit(-1 << 63))
            out.append((k, F.coalesce(value, F.lit(0)), (most - least).bit_length() if most - least < 1 << 63 else 64))
        if some < total:
            out.append((f"{k}_null", F.col(k).isNull().cast("long"), 1))
    return total, out


def _before(counts: DataFrame) -> DataFrame:
    """(block, digit, start): where the block's rows of that digit begin."""
    run = F.shiftright("block", BLOCK_BITS)
    n = counts.withColumn("run", run)
    per_run = n.groupBy("digit", "run").agg(F.sum("n").alias("n"))
    per_digit = per_run.groupBy("digit").agg(F.sum("n").alias("n"))
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    digits = per_digit.select("digit", earlier(Window.orderBy("digit")).alias("d0"))
    runs = per_run.select("digit", "run", earlier(Window.partitionBy("digit").orderBy("run")).alias("r0"))
    blocks = n.select("digit", "run", "block", earlier(Window.partitionBy("digit", "run").orderBy("block")).alias("b0"))
    return (blocks.join(runs, ["digit", "run"]).join(digits, "digit")
            .select("block", "digit", (F.col("d0") + F.col("r0") + F.col("b0")).alias("start")))


def places(rows: DataFrame, at: str, keys: list[str]) -> tuple[DataFrame, int]:
    """(``at``, place from 0) of every row, and how many rows there are. ``at`` is
    a unique id written with the rows, as ``monotonically_increasing_id`` makes it;
    ``keys`` are bigint columns, the most significant last, ascending."""
    total, digits = _passes(rows, keys)
    now = rows.select(F.col(at).alias("at"), F.col(at).alias("place"), *(v.alias(k) for k, v, _ in digits))
    for k, _, bits in digits:
        for shift in range(0, bits, DIGIT_BITS):
            value = F.shiftrightunsigned(k, shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int")
            cut = now.select("*", value.alias("digit"), F.shiftright("place", BLOCK_BITS).alias("block"))
            start = _before(cut.groupBy("block", "digit").agg(F.count(F.lit(1)).alias("n")))
            local = F.row_number().over(Window.partitionBy("block", "digit").orderBy("place")) - 1
            now = written(cut.join(start, ["block", "digit"]).withColumn("place", F.col("start") + local).select(now.columns), "radix")
    if not any(bits for _, _, bits in digits):  # no two rows differ: stored order
        cut = now.select("*", F.lit(0).alias("digit"), F.shiftright("place", BLOCK_BITS).alias("block"))
        start = _before(cut.groupBy("block", "digit").agg(F.count(F.lit(1)).alias("n")))
        local = F.row_number().over(Window.partitionBy("block", "digit").orderBy("place")) - 1
        now = cut.join(start, ["block", "digit"]).withColumn("place", F.col("start") + local)
    return now.select(F.col("at").alias(at), "place"), total
