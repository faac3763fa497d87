"""Sharding along a Hilbert curve over several metadata dimensions.

Every dimension is quantised into ``2 ** BITS`` cells of about equal row counts
(cut points from approximate percentiles over all rows), the cell's place on the
Hilbert curve through the dimensions is computed, and rows are ordered by that
index. Neighbours on the curve are neighbours in every dimension, so a run of it
has narrow ranges in all of them: a file cut from a run is skipped by filters on
any one dimension.

Law ``rows``: shard = place * shards / rows. Counts are at most one apart.

The order is made with one range partitioning, so no task holds more than its
share whatever repeats; inside a partition rows are numbered by their place, and
the partitions' counts give each its offset. Everything is a Column expression;
no Python runs on the executors.

Defined results: a null dimension lies in the first cell; a null text has size
1 and crc 0; equal rows take neighbouring places; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import utf8_bytes, written

BITS = 4
SHARDS = 16
#: Accuracy of the percentiles (relative rank error 1 / ACCURACY).
ACCURACY = 2000


def text_code(value: Column) -> Column:
    """A number that keeps the order of texts: their first six bytes."""
    head = F.rpad(F.hex(F.substr(F.coalesce(value, F.lit("")).cast("binary"), F.lit(1), F.lit(6))), 12, "0")
    return F.conv(head, 16, 10).cast("bigint")


def cut_points(df: DataFrame, codes: dict[str, Column]) -> dict[str, list]:
    """Of every dimension the percentiles that bound its cells."""
    steps = [i / 2**BITS for i in range(1, 2**BITS)]
    found = df.agg(*[F.percentile_approx(c, steps, ACCURACY).alias(name) for name, c in codes.items()]).first()
    return {name: sorted(set(found[name] or [])) for name in codes}


def cell(code: Column, cuts: list) -> Column:
    """The code's rank among the cut points, spread over 0 to 2 ** BITS - 1 (a
    dimension of few values uses the top bits too)."""
    place = F.lit(0)
    for c in cuts:
        place = place + F.when(code > F.lit(c), 1).otherwise(0)
    wide = F.floor(place * (2**BITS - 1) / F.lit(max(len(cuts), 1)))
    return F.coalesce(wide, F.lit(0)).cast("int")


def _rotate(value: int, by: int, n: int) -> int:
    by %= n
    return (value << by | value >> (n - by)) & (1 << n) - 1


def curve_index(cells: list[Column]) -> Column:
    """Place on the Hilbert curve through len(cells) dimensions of ``BITS`` bits.

    Bit level by bit level, from the top: the level's bits of all dimensions name
    a corner of the cube in the frame of the current sub-cube (entry corner e,
    direction d); the corner's rank in Gray code order is the next digit of the
    index, and decides the frame of the next level."""
    n, size = len(cells), 1 << len(cells)

    def trailing_ones(i: int) -> int:
        return 0 if not i & 1 else 1 + trailing_ones(i >> 1)

    def entry(w: int) -> int:
        return 0 if w == 0 else (i := 2 * ((w - 1) // 2)) ^ i >> 1

    def turn(w: int) -> int:
        return 0 if w == 0 else (trailing_ones(w - 1) if w % 2 == 0 else trailing_ones(w)) % n

    rank = [0] * size
    for i in range(size):
        rank[i ^ i >> 1] = i
    # the next digit, entry and direction by (e, d, corner), as small tables
    digit, into, towards = [], [], []
    for e in range(size):
        for d in range(n):
            for corner in range(size):
                w = rank[_rotate(corner ^ e, n - (d + 1) % n, n)]
                digit.append(w)
                into.append(e ^ _rotate(entry(w), d + 1, n))
                towards.append((d + turn(w) + 1) % n)
    lists = {k: F.array(*map(F.lit, v)) for k, v in (("digit", digit), ("into", into), ("towards", towards))}

    def step(state: Column, level: Column) -> Column:
        corner = F.lit(0)
        for i, c in enumerate(cells):
            corner = corner + F.call_function("shiftright", c, level).bitwiseAND(1) * (1 << i)
        at = (state["e"] * n + state["d"]) * size + corner
        return F.struct((state["h"] * size + F.get(lists["digit"], at)).cast("bigint").alias("h"),
                        F.get(lists["into"], at).alias("e"), F.get(lists["towards"], at).alias("d"))

    start = F.struct(F.lit(0).cast("bigint").alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    levels = F.array(*[F.lit(b) for b in reversed(range(BITS))])
    return F.aggregate(levels, start, step, lambda s: s["h"])


def placed(df: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """df with ``name``, its place from 0 in the given order, and the row count.
    The sorted rows are written once; partition counts (one row per partition)
    give the offsets."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id())
    table = written(sorted_rows.sortWithinPartitions(*order)
                    .withColumn("__pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "ordered")
    counts = table.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n")).first().n
    return (table.join(F.broadcast(offsets), "__part").withColumn(name, F.col("__off") + F.col("__pos"))
            .drop("__part", "__pos", "__off"), total)


def ordered(docs: DataFrame, dimensions: dict[str, Column], keep: list[Column], ties: list[str]) -> tuple[DataFrame, int]:
    """``keep`` columns, the dimensions' cells, hilbert and place (from 0); rows
    of one cell are ordered by ``ties``."""
    codes = docs.select(*keep, *[c.alias(f"__{name}") for name, c in dimensions.items()])
    kept = [f for f in codes.columns if not f.startswith("__")]
    codes = written(codes, "curve-input")
    cuts = cut_points(codes, {name: F.col(f"__{name}") for name in dimensions})
    cells = {name: cell(F.col(f"__{name}"), cuts[name]) for name in dimensions}
    in_cells = codes.select(*kept, *[c.alias(f"cell_{name}") for name, c in cells.items()])
    indexed = in_cells.withColumn("hilbert", curve_index([F.col(f"cell_{name}") for name in dimensions]))
    return placed(indexed, ["hilbert", *ties], "place")


def document_dimensions() -> dict[str, Column]:
    return {"lang": text_code(F.col("lang")), "source": text_code(F.col("source")), "bytes": utf8_bytes(F.col("text"))}


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, hilbert. Texts are
    read once; all that follows moves rows of five numbers."""
    keep = [F.col("doc_id").cast("bigint").alias("doc_id"), (utf8_bytes(F.col("text")) + 1).alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("bigint").alias("text_crc32")]
    rows, total = ordered(docs, document_dimensions(), keep, ["text_crc32", "doc_id", "size"])
    # a shard begins at the least place that the division sends to it
    return (rows.withColumn("shard", F.expr(f"cast(place * {shards} div {max(total, 1)} as int)"))
            .withColumn("begin", F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (F.col("place") - F.col("begin")).cast("bigint").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "hilbert"))


def write_shards(docs: DataFrame, dimensions: dict[str, Column], ties: list[str], path: str, shards: int = SHARDS) -> None:
    """The whole rows of ``docs`` as one folder per shard, sorted along the curve,
    so that file and row-group statistics prune on every dimension."""
    rows, total = ordered(docs, dimensions, [F.col(f"`{c}`") for c in docs.columns], ties)
    numbered = rows.withColumn("shard", F.expr(f"cast(place * {shards} div {max(total, 1)} as int)"))
    names = [f"cell_{name}" for name in dimensions]
    (numbered.sortWithinPartitions("shard", "place").drop("place", "hilbert", *names)
     .write.partitionBy("shard").parquet(path))
