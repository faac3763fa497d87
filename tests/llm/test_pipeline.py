"""The stages against their operators' brute-force rules on a small table."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline as P
import public_tokenizers
from pyspark import cloudpickle
from test_dartminhash import brute_force
from tokenizers import Tokenizer

from thalimart.llm import bpe_stream, common, dartminhash, decontaminate


def test_stages_on_planted_documents(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    spoken = P.language_id(spark, docs, sf)
    assert spoken.columns == docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    kept = sorted(r.doc_id for r in spoken.collect())
    assert len(kept) >= 0.98 * len(rows)
    assert all(any(c.isalpha() for c in rows[i].text) for i in kept)
    spoken.write.parquet(str(tmp_path / "a"))
    spoken = spark.read.parquet(str(tmp_path / "a"))
    single = P.near_dedup(spark, spoken, sf)
    assert single.columns == docs.columns
    root = brute_force([rows[i].text for i in kept])
    assert sorted(r.doc_id for r in single.collect()) == [kept[i] for i in sorted(set(root))]
    single.write.parquet(str(tmp_path / "b"))
    single = spark.read.parquet(str(tmp_path / "b"))
    clean = P.decontamination(spark, single, sf)
    bad = {r.doc_id for r in decontaminate.leaks(single, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - bad
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r.n_tokens for r in P.run(spark, sf).collect()}
    assert got == {r.doc_id: len(lib.encode(r.text, add_special_tokens=False).ids) for r in clean.collect()}


def test_empty_and_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, tid int"
    rows = [(1, None, "en", "s", 0, 1), (None, "the one and only text in here", "en", "s", 1, 2), (3, "", None, None, None, 3), (4, "12 34", "en", "s", 5, 4)]
    for data in ([], rows):
        docs = spark.createDataFrame(data, schema)
        for n, (_, stage) in enumerate(P.STAGES):
            out = stage(spark, docs, "/root/testdata/sf0.001")
            path = str(tmp_path / f"{len(data)}-{n}")
            out.write.parquet(path)
            docs = spark.read.schema(out.schema).parquet(path)
        assert docs.count() <= len(data)


def test_a_leaking_row_takes_no_other_row_of_its_id_along(spark, tmp_path):
    item = "the seven brothers counted all their sheep twice before they went home over the long bridge at night"
    spark.createDataFrame([(1, item, "")], "item_id long, text string, slots string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, f"see {item}", 1), (None, "a clean text", 2), (None, None, 3), (5, item, 4), (5, "another clean text", 5), (5, None, 6), (6, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    clean = P.decontamination(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    assert sorted(r.n for r in clean.collect()) == [2, 3, 5, 6, 7]


def test_code_switched_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r for r in docs.where("n_chars > 900").collect()), key=lambda r: r.doc_id)
    cut = {lang: [w for r in rows if r.lang == lang for w in r.text.split()] for lang in ("de", "en", "es", "fr")}
    mixed = [" ".join(cut[a][n * 40:n * 40 + 40] + cut[b][n * 30:n * 30 + 30] + cut[c][n * 30:n * 30 + 30])
             for n, (a, b, c) in enumerate([("de", "en", "es"), ("en", "fr", "de"), ("es", "de", "fr"), ("fr", "es", "en")])]
    more = spark.createDataFrame([(10**9 + n, t) for n, t in enumerate(mixed)], "doc_id long, text string")
    both = docs.unionByName(more, allowMissingColumns=True)
    kept = {r.doc_id for r in P.language_id(spark, both, "").select("doc_id").collect()}
    gone = [r for r in both.collect() if r.doc_id not in kept]
    assert [r for r in gone if r.text and any(c.isalpha() for c in r.text)] == []  # only texts without a letter may go


def test_a_worker_gives_up_what_the_stage_before_remembered():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        bpe_stream.load(f.read())
    assert bpe_stream._MERGES
    common.take_over("another stage", list)
    assert not bpe_stream._MERGES


def test_given_up_memory_goes_back_to_the_system():
    """Blocks held by the C library below one that is still in use."""
    code = """
import os, sys
from thalimart.llm import common
def resident(): return int(open("/proc/self/statm").read().split()[1]) * os.sysconf("SC_PAGE_SIZE")
kept = [bytes(2000) + b"x" for _ in range(60_000)]
last = b"y" * 2000 + os.urandom(8)
common.take_over("one stage", kept.clear)
full = resident()
common.take_over("another stage", list)
print(full - resident())
"""
    root = str(Path(common.__file__).parents[2])
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True, timeout=120).stdout
    assert int(out) > 80e6


def test_what_reaches_a_worker_forgets_the_workers_own_cache():
    dartminhash.shingles(["some words"])
    decontaminate.tokens(["some words"])
    for module, cache in ((dartminhash, dartminhash._HASHES), (decontaminate, decontaminate._TOKENS)):
        assert cache
        cloudpickle.loads(cloudpickle.dumps(module._forget))()
        assert not cache


def test_texts_go_to_workers_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    own = key in spark.conf.getAll
    spark.conf.unset(key)
    docs = common.short_batches(spark.range(40).selectExpr("id", "repeat('x', 1000000) AS text").coalesce(1))
    sizes = docs.mapInArrow(lambda batches: (b.select(["id"]).slice(0, 1) for b in batches), "id long").count()
    assert sizes >= 8
    spark.conf.set(key, "1m")
    assert common.short_batches(docs) and spark.conf.get(key) == "1m"
    spark.conf.set(key, old) if own else spark.conf.unset(key)
