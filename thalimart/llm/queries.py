"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe_stream, crf_langid, dartminhash, decontaminate, expected, geometric_blocks, hilbert,
               license_scan, orc_tokens, pii_anchors, rp_forest, target_resampling, url_templates, warc_arc)
from .common import scratch, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every
    page, from the WARC files."""
    records = warc_arc.archive(table(spark, sf_dir, "pages"), scratch(spark, "archives"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_forest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: 20 neighbours of every twentieth vector."""
    return rp_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


#: The list's rules, in no order: the longest that fits decides.
URL_RULES = [url_templates.Rule(verdict, text) for verdict, text in (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))]


def op3_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    judged = url_templates.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, license, containment of every notice found."""
    return license_scan.scan(table(spark, sf_dir, "documents")).select("doc_id", "license", "containment")


def op5_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = crf_langid.fit(docs, crf_langid.trained_rows(docs.doc_id))
    found = crf_langid.predict(docs, model)
    return found.select("doc_id", crf_langid.held_out(found.doc_id).alias("held_out"), "lang_pred", "score")


def op6_streaming_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return bpe_stream.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, n_windows, matched, verbatim of every leaked item."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the ORC files."""
    path = scratch(spark, "orc-tokens")
    orc_tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return orc_tokens.digests(spark, path)


def op9_dartminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id, kept of every document."""
    return dartminhash.classes(table(spark, sf_dir, "documents"))


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    return hilbert.sharded(table(spark, sf_dir, "documents"))


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document."""
    return target_resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document."""
    found = pii_anchors.personal(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    base = pii_anchors.listed(spans, pii_anchors.BASE)
    return found.select("doc_id", *(pii_anchors.counted(spans, k).alias(f"n_{k}") for k in pii_anchors.BASE),
                        F.sha2(base.cast("binary"), 256).alias("base_sha256"), pii_anchors.listed(spans).alias("spans"))


def op13_geometric_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, rank, doc_id, score: the 20 best documents of every item."""
    return geometric_blocks.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_arc_to_warc": op1_arc_to_warc,
    "op2_forest_neighbours": op2_forest_neighbours,
    "op3_url_templates": op3_url_templates,
    "op4_license_scan": op4_license_scan,
    "op5_language_crf": op5_language_crf,
    "op6_streaming_bpe": op6_streaming_bpe,
    "op7_template_leaks": op7_template_leaks,
    "op8_orc_tokens": op8_orc_tokens,
    "op9_dartminhash": op9_dartminhash,
    "op10_hilbert_shards": op10_hilbert_shards,
    "op11_target_resampling": op11_target_resampling,
    "op12_pii_anchors": op12_pii_anchors,
    "op13_geometric_blocks": op13_geometric_blocks,
}

SQL: dict[str, str] = {
    "op1_arc_to_warc": expected.ARC_TO_WARC,
    "op3_url_templates": expected.url_templates(URL_RULES),
    "op4_license_scan": expected.license_scan(),
    "op13_geometric_blocks": expected.RANKED,
}
