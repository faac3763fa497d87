"""Importance resampling against a plain model, and the radix sort against sorted()."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from thalimart.llm import queries
from thalimart.llm.radix_sort import places
from thalimart.llm.target_resampling import resampled

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _features(text):
    found = WORD.findall((text or "").translate(SMALL))
    runs = found + [f"{a} {b}" for a, b in zip(found, found[1:])]
    return len(found), [zlib.crc32(x.encode()) % 10_000 for x in runs]


def _model(docs, target, percent=25, least=20, seed=7):
    own = [(i, *_features(t)) for i, t in docs]
    s = Counter(b for _, _, bs in own for b in bs)
    t = Counter(b for x in target for b in _features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in s}
    rows = []
    for i, n, bs in own:
        weight = sum(gain[b] for b in bs) // len(bs) if bs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = able[:percent * len(able) // 100]
    return Counter((r[0], r[2], r[3], r[4], next((k for k, x in enumerate(drawn, 1) if x is r), None)) for r in rows)


def _texts(n, seed):
    pick = random.Random(seed)
    parts = ["alpha", "Beta", "gAmma", "été", "ÉTÉ", "7", "x1", "naïve", "日本", "-", "_", "\x7f", "\n", "'"]
    return [" ".join(pick.choices(parts, k=pick.randrange(0, 90))) for _ in range(n)]


def test_equals_the_model_with_nulls_empty_and_long_texts(spark):
    docs = list(enumerate(_texts(120, 1))) + [(None, "one " * 30), (500, None), (501, ""), (502, "a b " * 30_000), (-3, "one two " * 15)]
    target = [*_texts(9, 2), None, ""]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = resampled(frame, spark.createDataFrame([(t,) for t in target], "text string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == _model(docs, target)


def test_query_equals_the_model(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("text").collect()]
    assert Counter(map(tuple, queries.QUERIES["op11_target_resampling"](spark, sf).collect())) == _model(docs, target)


def test_empty_tables_repeated_rows_and_clashing_names(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "w " * 25, 4, 9)] * 8, "doc_id long, text string, `a.b` int, rank int")
    assert resampled(none, some).count() == 0
    got = resampled(some, none, keep=("a.b", "rank", "text")).collect()
    assert got[0].asDict().keys() == {"a.b", "rank", "text", "n_features", "weight", "score", "rank_"}
    assert sorted(r.rank_ or 0 for r in got) == [0] * 6 + [1, 2]
    assert {r.n_features for r in got} == {49}


@pytest.mark.parametrize("low,high", [(0, 0), (-3, 4), (0, 70_000), (-(1 << 63), (1 << 63) - 1)])
def test_radix_places_equal_a_stable_sort(spark, low, high):
    pick = random.Random(high)
    rows = [(pick.choice([None, low, high, pick.randint(low, high)]), pick.randint(0, 3)) for _ in range(5000)]
    frame = spark.createDataFrame(rows, "a long, b long").repartition(7).withColumn("at", F.monotonically_increasing_id()).cache()
    stored = sorted(map(tuple, frame.select("at", "a", "b").collect()))
    want = sorted(stored, key=lambda r: (r[2], r[1] is None, r[1] or 0))
    got, total = places(frame, "at", ["a", "b"])
    assert total == 5000
    assert [r[0] for r in sorted(map(tuple, got.collect()), key=lambda r: r[1])] == [r[0] for r in want]
    assert sorted(r[1] for r in got.collect()) == list(range(5000))
    frame.unpersist()
