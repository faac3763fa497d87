"""Forest search against all pairs: recall, exact scores, ties and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from thalimart.llm import rp_forest as R


def exact(rows, k, step=20):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    out = {}
    for i in np.flatnonzero(ids % step == 0):
        s = np.einsum("ij,j->i", x, x[i])
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


def recall_of(spark, path, sample=None):
    table = spark.read.parquet(path)
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want = exact(rows, 20)
    got: dict = {}
    for r in R.nearest(table, F.col("id") % 20 == 0, 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    hits = 0
    for q, near in want.items():
        own = sorted(got[q])
        assert [x[0] for x in own] == list(range(1, len(own) + 1)) and len(own) == min(20, len(rows) - 1)
        assert [x[1:] for x in own] == sorted(((v, s) for _, v, s in own), key=lambda x: (-x[1], x[0]))
        assert all(np.isclose(s, vectors[q] @ vectors[v], rtol=0, atol=1e-12) for _, v, s in own)
        hits += len({v for v, _ in near} & {v for _, v, _ in own})
    return hits / sum(map(len, want.values()))


def test_recall_small(spark):
    assert recall_of(spark, "/root/testdata/sf0.01/embeddings.parquet") >= 0.9


def test_recall_on_more_rows_than_leaves_hold(spark):
    assert recall_of(spark, "/root/testdata/sf0.1/embeddings.parquet") >= 0.9


def test_whole_effort_is_exact_with_ties_and_copies(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 5)).round(1)
    rows = [(i, base[rng.integers(30)].tolist()) for i in range(700)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got: dict = {}
    for r in R.nearest(table, F.col("id") % 20 == 0, 7, effort=9.0, leaf=8, trees=3).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: [x[1:] for x in sorted(v)] for q, v in got.items()} == exact(rows, 7)


def test_hot_leaf_is_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_ROWS", 50)
    monkeypatch.setattr(R, "BLOCK_QUERIES", 3)
    rows = [(i, [1.0, 2.0] if i % 3 else [float(i), 1.0]) for i in range(600)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got: dict = {}
    for r in R.nearest(table, F.col("id") % 20 == 0, 5, effort=9.0, leaf=16, trees=2).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: [x[1:] for x in sorted(v)] for q, v in got.items()} == exact(rows, 5)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (20, [0.5, 0.5], 2), (1, [2.0, 1.0], 3), (2, None, 4), (3, [0.0, 0.0], 5), (4, [nan, 1.0], 6), (5, [inf, 1.0], 7),
            (6, [None, 1.0], 8), (7, [], 9), (None, [1.0, 1.0], 10), (8, [1.0, 2.0, 3.0], 11), (1, [0.1, 0.1], 12), (40, None, 13)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id int")
    got = sorted(tuple(r) for r in R.nearest(table, F.col("id") % 20 == 0, 20).collect())
    assert got == [(0, 1, 1, 2.0), (0, 2, 20, 0.5), (20, 1, 1, 1.5), (20, 2, 0, 0.5)]


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(1, [1.0]), (2, [2.0])]])
def test_tables_without_a_result(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert R.nearest(table, F.col("id") % 20 == 0, 20).collect() == []
