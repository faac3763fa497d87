"""Nearest neighbours by a forest of random-projection trees.

Index. Each tree splits a bounded sample (``SAMPLE`` rows, those with the smallest
hash of their id) at the median of its projections on a random direction (the
difference of two random sample points) down to ``LEAF`` sample rows. The forest
(at most ``TREES * SAMPLE / LEAF`` nodes) is broadcast; every row of the table
is put into one leaf of every tree.

Search. A query walks all trees through one priority queue: the branch with the
smallest distance to a split passed on the wrong side comes next, whatever its
tree. It stops once the leaves it reached hold ``EFFORT`` times the rows of the
table (leaves of different trees overlap). Queries and rows then meet by
(tree, leaf); candidates are ranked by their exact inner product in double
precision, the best ``k`` of every task first and of every query afterwards.

``EFFORT`` is the price of recall. On vectors without structure (64 independent
dimensions, as in the test tables) 0.9 recall needs about as much work as one
pass over the rows; clustered vectors need far less.

A leaf that holds more than ``BLOCK_ROWS`` rows or ``BLOCK_QUERIES`` queries (many
equal vectors) is dealt out in blocks: its rows to row blocks, its queries to
query blocks, every pair of blocks to one task.

Defined results: vectors that are null, empty, zero, of another length than most
of the sample, or that hold null or non-finite components take no part, nor
rows without an id; rows with one id are one candidate (its best product) and
one query each by the smallest vector; ties go to the smaller id; with no other
row a query has no result; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

TREES = 8
SAMPLE = 16_384
LEAF = 32
EFFORT = 1.25
BLOCK_ROWS, BLOCK_QUERIES = 8192, 2048
#: Queries whose best candidates a task holds before it hands them on.
HELD_QUERIES = 20_000


@dataclass
class Forest:
    """Trees laid end to end: node i sends a vector to left[i] or right[i] by
    vector @ normal[i] >= cut[i]; children under 0 are leaves ~x."""

    roots: list[int]
    normal: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray     # of the sample, by leaf
    width: int


def usable(vector: Column) -> Column:
    """Vectors that take part."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def clean(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, vec (doubles) of the rows that take part."""
    rows = table.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    return rows.where(F.col("id").isNotNull() & usable(F.col("vec")))


def grow(points: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 7) -> Forest:
    """A forest over the sample. Points that no direction separates stay one leaf."""
    rng = np.random.default_rng(seed)
    normal, cut, left, right, share, roots = [], [], [], [], [], []

    def node(index: np.ndarray) -> int:
        if len(index) > leaf:
            for _ in range(4):
                a, b = points[rng.choice(index, 2, replace=False)]
                length = np.linalg.norm(a - b)
                if length == 0:
                    continue
                w = (a - b) / length
                p = points[index] @ w
                middle = np.median(p)
                upper = p >= middle
                if upper.all() or not upper.any():
                    continue
                at = len(cut)
                normal.append(w)
                cut.append(middle)
                left.append(0)
                right.append(0)
                left[at], right[at] = node(index[~upper]), node(index[upper])
                return at
        share.append(len(index) / len(points))
        return ~(len(share) - 1)

    for _ in range(trees):
        roots.append(node(np.arange(len(points))))
    return Forest(roots, np.array(normal).reshape(len(cut), points.shape[1]), np.array(cut), np.array(left, np.int64),
                  np.array(right, np.int64), np.array(share), points.shape[1])


def fit(rows: DataFrame, trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF) -> Forest | None:
    """A forest from at most ``sample`` rows, chosen by a hash of the id."""
    order = F.xxhash64("id", F.lit(3))
    picked = rows.orderBy(order, "id", "vec").limit(sample).toArrow()
    vectors = picked.column("vec").to_pylist()
    if not vectors:
        return None
    width = int(np.median([len(v) for v in vectors]))
    return grow(np.array([v for v in vectors if len(v) == width], np.float64), trees, leaf)


def leaves_of(forest: Forest, x: np.ndarray) -> np.ndarray:
    """(rows, trees) leaf of every vector in every tree."""
    out = np.empty((len(x), len(forest.roots)), np.int32)

    def down(node: int, index: np.ndarray, tree: int) -> None:
        if node < 0:
            out[index, tree] = ~node
        elif len(index):
            upper = x[index] @ forest.normal[node] >= forest.cut[node]
            down(forest.left[node], index[~upper], tree)
            down(forest.right[node], index[upper], tree)

    for tree, root in enumerate(forest.roots):
        down(root, np.arange(len(x)), tree)
    return out


def search(forest: Forest, x: np.ndarray, effort: float) -> list[int]:
    """The leaves one query reaches, best first, through one queue of all trees."""
    side = forest.normal @ x - forest.cut
    queue = [(0.0, n, root) for n, root in enumerate(forest.roots)]
    count, found, seen = len(queue), [], 0.0
    while queue and seen < effort:
        margin, _, node = heapq.heappop(queue)
        while node >= 0:
            s = side[node]
            near, far = (forest.right[node], forest.left[node]) if s >= 0 else (forest.left[node], forest.right[node])
            heapq.heappush(queue, (max(margin, abs(s)), count, far))
            count += 1
            node = near
        found.append(~node)
        seen += forest.share[~node]
    return found


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _with_leaves(rows: DataFrame, forest: Forest, effort: float | None) -> DataFrame:
    """id, vec and the list of leaves: one per tree, or those a search reaches."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            x = _matrix(batch.column(1), own.width)
            if effort is None:
                found = pa.array(list(leaves_of(own, x)), pa.list_(pa.int32()))
            else:
                found = pa.array([search(own, v, effort) for v in x], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=["id", "vec", "leaves"])

    return rows.where(F.size("vec") == forest.width).mapInArrow(run, "id bigint, vec array<double>, leaves array<int>")


def _scored(dealt: DataFrame, k: int, width: int) -> DataFrame:
    """query_id, vec_id, score: per task the best k of every query. Rows come
    sorted by block, a block's queries before its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            ids = list(held)
            for begin in range(0, len(ids), 2000):
                part = ids[begin:begin + 2000]
                sizes = [len(held[q][0]) for q in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array(part, np.int64), sizes)),
                     pa.array(np.concatenate([held[q][0] for q in part])),
                     pa.array(np.concatenate([held[q][1] for q in part]))], names=["query_id", "vec_id", "score"])
            held.clear()

        block, queries, vectors = None, [], []
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
            kind, ids = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            x = _matrix(batch.column(5), width)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1) | (kind[1:] != kind[:-1])) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(ids)]):
                if begin == end:
                    continue
                if (own := tuple(keys[begin])) != block:
                    block, queries, vectors = own, [], []
                if kind[begin] == 0:
                    queries.append(ids[begin:end])
                    vectors.append(x[begin:end])
                elif queries:
                    qs, m = np.concatenate(queries), np.concatenate(vectors)
                    for i, q in enumerate(qs):
                        # a sum of products in a fixed order: equal vectors score equally
                        score = np.einsum("ij,j->i", x[begin:end], m[i])
                        wanted = ids[begin:end] != q
                        if q in held and len(held[q][1]) == k:
                            wanted &= score >= held[q][1][-1]
                        new, score = ids[begin:end][wanted], score[wanted]
                        if q in held:
                            new, score = np.concatenate([held[q][0], new]), np.concatenate([held[q][1], score])
                        order = np.lexsort((new, -score))
                        new, score = new[order], score[order]
                        _, first = np.unique(new, return_index=True)
                        first.sort()
                        held[q] = new[first[:k]], score[first[:k]]
                    if len(held) > HELD_QUERIES:
                        yield from out()
        yield from out()

    return dealt.mapInArrow(run, "query_id bigint, vec_id bigint, score double")


def nearest(table: DataFrame, queries: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
            effort: float = EFFORT, trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row whose id
    satisfies ``queries`` (a Column over ``id``)."""
    spark = table.sparkSession
    rows = clean(table, id_col, vector_col)
    forest = fit(rows, trees, sample, leaf)
    if forest is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    asked = rows.where(queries).groupBy("id").agg(F.min("vec").alias("vec"))
    placed = written(_with_leaves(rows, forest, None), "forest-rows")
    sought = written(_with_leaves(asked, forest, effort), "forest-queries")

    def counted(df: DataFrame, block: int, name: str) -> DataFrame:
        return df.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(
            F.ceil(F.count(F.lit(1)) / block).cast("int").alias(name))

    # one row per leaf of the forest: bounded by TREES * SAMPLE / LEAF
    blocks = F.broadcast(counted(placed, BLOCK_ROWS, "rb").join(counted(sought, BLOCK_QUERIES, "qb"), "leaf"))
    row_side = (placed.select("id", "vec", F.explode("leaves").alias("leaf")).join(blocks, "leaf")
                .select("leaf", F.pmod(F.xxhash64("id"), F.col("rb")).cast("int").alias("r"),
                        F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("q"), F.lit(1).alias("kind"), "id", "vec"))
    query_side = (sought.select("id", "vec", F.explode("leaves").alias("leaf")).join(blocks, "leaf")
                  .select("leaf", F.explode(F.sequence(F.lit(0), F.col("rb") - 1)).alias("r"),
                          F.pmod(F.xxhash64("id"), F.col("qb")).cast("int").alias("q"), F.lit(0).alias("kind"), "id", "vec"))
    dealt = query_side.unionByName(row_side)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, "leaf", "r", "q").sortWithinPartitions("leaf", "r", "q", "kind", "id")
    found = _scored(dealt, k, forest.width).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
