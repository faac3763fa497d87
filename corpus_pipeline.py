"""A training corpus from ``documents``: identify the language, drop near copies,
drop benchmark leaks, encode.

Every stage reads what its predecessor wrote and decides about whole texts. A
row is dropped only by the decision of its stage: language identification drops
texts without a language (null, no letter, or words that are on average less than
half certain of their own language, so texts that switch languages stay); near-dedup keeps one document of each class; decontamination drops
documents that leak a benchmark item. The last stage returns the encoded
documents. Empty tables give empty results; extra columns pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thalimart.llm import bpe_stream, crf_langid, dartminhash, decontaminate
from thalimart.llm.common import fresh, quoted, scratch, table, written

#: A text whose words' best languages have a smaller mean share is rejected.
LEAST_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words have a language (operator 5)."""
    model = crf_langid.fit(docs, crf_langid.trained_rows(docs.doc_id))
    lang, score, share = (fresh(m, docs.columns) for m in ("__lang", "__score", "__share"))
    found = crf_langid.predict(docs, model, tuple(docs.columns), marks=(lang, score, share))
    sure = (F.col(lang) != crf_langid.UNKNOWN) & (F.col(share) >= LEAST_SHARE)
    return found.where(sure).select(*map(quoted, docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (operator 9): the row whose id is
    the class's; of rows that repeat this id, the smallest. A class without any
    id keeps its smallest row."""
    return dartminhash.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item (operator 7). Texts are judged, so
    rows with one id, or none, do not stand for each other."""
    tid, leaky = (fresh(m, docs.columns) for m in ("__tid", "__leaky"))
    leaks = written(decontaminate.text_leaks(docs, table(spark, sf_dir, "benchmark")).select(F.col("tid").alias(leaky)).distinct(), "leaky")
    # null texts leak nothing; numbers spread them over the join
    key = F.coalesce(decontaminate.text_id(F.col("text")), F.concat(F.lit("null text in row "), F.monotonically_increasing_id().cast("string")).cast("binary"))
    return docs.withColumn(tid, key).join(leaks, F.col(tid) == F.col(leaky), "left_anti").select(*map(quoted, docs.columns))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left (operator 6)."""
    return bpe_stream.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

#: SQL can express neither the trained field nor the hashed signatures; the tests
#: hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
