"""Columns of any name and type pass through the stages; numerals are no letters."""

import corpus_pipeline as P
from pyspark.sql import functions as F

from thalimart.llm import crf_langid as C
from thalimart.llm import dartminhash as D


def test_stages_pass_columns_of_any_name(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    odd = docs.select("*", F.lit("x").alias("__lang"), F.lit(1).alias("a.b"), F.lit(2).alias("__tid"), F.lit(3).alias("__LEAKY"), F.lit(4).alias("`q`"))
    for n, (_, stage) in enumerate(P.STAGES[:-1]):
        out = stage(spark, odd, "/root/testdata/sf0.001")
        assert out.columns == odd.columns
        out.write.parquet(str(tmp_path / str(n)))
        odd = spark.read.parquet(str(tmp_path / str(n)))
    assert 0 < odd.count() <= 40 and odd.where("`a.b` = 1").count() == odd.count()


def test_repeated_rows_with_a_map_column(spark):
    rows = [(1, "one two three four five six", {"k": 2}), (1, "one two three four five six", {"k": 1}), (2, "other words here now five", {})]
    got = D.representatives(spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>")).collect()
    assert sorted((r.doc_id, str(r.m)) for r in got) == [(1, "{'k': 1}"), (2, "{}")]


def test_numerals_without_a_letter_are_no_words(spark):
    assert C.words("½ ⅷ ² x² été") == ["x²", "été"] and C.words("a1b 2") == ["a", "b"]
    docs = spark.createDataFrame([(1, "alpha beta " * 9, "x"), (2, "rot blau " * 9, "y"), (3, "½ ⅷ ²", "x")], "doc_id long, text string, lang string")
    model = C.fit(docs, F.col("doc_id") > 0)
    assert [(r.lang_pred, r.score) for r in C.predict(docs.where("doc_id = 3"), model).collect()] == [("und", 0.0)]


def test_many_languages_share_the_training_characters(spark, monkeypatch):
    monkeypatch.setattr(C, "TRAIN_TOTAL", 4000)
    seen = []
    monkeypatch.setattr(C, "train", lambda rows: seen.extend(rows))
    docs = spark.createDataFrame([(i, f"w{i % 2} " * 5000, f"l{i % 2}") for i in range(8)], "doc_id long, text string, lang string")
    C.fit(docs, F.col("doc_id") >= 0, train_docs=4)
    assert len(seen) == 8 and max(len(t) for _, t, _ in seen) <= 500 + C.PIECES
