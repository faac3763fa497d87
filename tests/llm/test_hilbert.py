"""The curve's defining property, the law's counts, and pruning."""

import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from thalimart.llm import hilbert as H


@pytest.mark.parametrize("n", [2, 3, 4])
def test_curve_visits_every_cell_once_and_steps_to_neighbours(spark, n, monkeypatch):
    monkeypatch.setattr(H, "BITS", 3 if n < 4 else 2)
    side = 2**H.BITS
    cells = list(itertools.product(range(side), repeat=n))
    names = [f"c{i}" for i in range(n)]
    df = spark.createDataFrame(cells, ", ".join(f"{c} int" for c in names)).withColumn("h", H.curve_index([F.col(c) for c in names]))
    by = sorted((r.h, tuple(r)[:n]) for r in df.collect())
    assert [h for h, _ in by] == list(range(side**n))
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for (_, a), (_, b) in itertools.pairwise(by))


def check(rows, got, shards=16):
    want = sorted((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows if r[0] is not None)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == want and len(got) == len(rows)
    counts = [sorted(r.slot for r in got if r.shard == s) for s in range(shards)]
    assert all(c == list(range(len(c))) for c in counts)
    assert max(map(len, counts)) - min(map(len, counts)) <= 1 and sum(map(len, counts)) == len(rows)
    assert all(r.law == "rows" and r.grown_shard is None for r in got)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = H.sharded(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], got)
    by_place = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.hilbert for r in by_place] == sorted(r.hilbert for r in got)


@pytest.mark.parametrize("n", [0, 1, 5, 16, 17, 100])
def test_odd_rows_and_hot_copies(spark, n):
    schema = "doc_id long, text string, lang string, source string, shard string, hilbert int"
    kinds = [("same text", "en", "s"), (None, None, None), ("", "é", ""), ("long " * 30_000, "fr", "src10")]
    rows = [(None if i == 3 else i // 2, *kinds[0 if i % 3 else i % 4], "x", 1) for i in range(n)]
    check(rows, H.sharded(spark.createDataFrame(rows, schema)).collect())


def test_only_builtin_expressions_run(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = H.sharded(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_files_prune_on_each_dimension(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    H.write_shards(docs, H.document_dimensions(), ["doc_id"], str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.drop("shard").exceptAll(docs).count() == 0 and back.count() == docs.count()
    spread = back.groupBy("lang").agg(F.count_distinct("shard").alias("n")).collect()
    assert min(r.n for r in spread) <= 8  # a language lies in part of the shards only
