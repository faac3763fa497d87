"""Reusable operators: first-row dedup, dense keys, substring match, splitters."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from thalimart.operators import cuisine as C
from thalimart.operators.dedup import first_per_key
from thalimart.operators.substring_match import first_substring_match
from thalimart.operators.surrogate import with_dense_key


def test_first_row_wins(spark):
    # M10: two users with id 7 - the first staged row is kept
    df = spark.createDataFrame([("7", "G", 0), ("7", "H", 1), ("8", "I", 0), ("7", "A", 2)],
                               "k string, name string, seq long")
    got = {r.k: r.name for r in first_per_key(df, ["k"], ["seq"]).collect()}
    assert got == {"7": "G", "8": "I"}


def test_dense_key_is_dense_and_ordered(spark):
    n = 5000
    df = spark.range(n).select((F.col("id") * 7919 % n).cast("string").alias("nk")) \
        .repartition(13)
    keyed = with_dense_key(df, [F.col("nk").asc()], "k").collect()
    assert sorted(r.k for r in keyed) == list(range(1, n + 1))
    by_key = [r.nk for r in sorted(keyed, key=lambda r: r.k)]
    assert by_key == sorted(by_key)


def test_dense_key_survives_projection(spark):
    # reading only the key column must not change the numbering
    df = spark.range(3000).select(F.col("id").alias("v"), (F.col("id") % 17).alias("w"))
    keyed = with_dense_key(df, [F.col("w").asc(), F.col("v").asc()], "k")
    full = {(r.v, r.k) for r in keyed.collect()}
    slim = keyed.select("k").collect()
    assert len(slim) == 3000 and {k for _, k in full} == {r.k for r in slim}


def _brute(texts, patterns):
    out = {}
    for t in texts:
        if t is None:
            continue
        hits = [k for p, k in patterns if p is not None and p.lower() in t.lower()]
        if hits:
            out[t] = min(hits)
    return out


def test_substring_match_semantics(spark):
    # M12: 'Baner,PUNE' contains 'Pune'; 'Pune' does not contain 'Baner,PUNE'
    texts = spark.createDataFrame([("Baner,PUNE",), ("Pune",), ("x",), (None,)], "city string")
    pats = spark.createDataFrame([("Pune", 2), ("Baner,PUNE", 1), ("une", 5)], "city string, k long")
    got = {r.city: r.k for r in first_substring_match(texts, "city", pats, "city", "k").collect()}
    assert got == {"Baner,PUNE": 1, "Pune": 2}


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text(alphabet="abAB,_ ", max_size=8), min_size=1, max_size=12),
       pats=st.lists(st.text(alphabet="abAB,_", max_size=5), min_size=1, max_size=8))
def test_substring_match_equals_brute_force(spark, texts, pats):
    keyed = [(p, i + 1) for i, p in enumerate(pats)]
    tdf = spark.createDataFrame([(t,) for t in texts], "city string")
    pdf = spark.createDataFrame(keyed, "city string, k long")
    got = {r.city: r.k for r in first_substring_match(tdf, "city", pdf, "city", "k").collect()}
    assert got == _brute(texts, keyed)


def _recursive_split(s):
    """Plain-Python model of the source's recursive splitter: emit the head,
    recurse on the tail while the tail is non-empty; keep non-empty heads,
    then trim."""
    if s is None:
        return []
    items, rest = [], s
    while True:
        cut = (rest + ",").index(",")
        items.append(rest[:cut])
        rest = rest[cut + 1:]
        if rest == "":
            break
    return sorted({i.strip(" ") for i in items if i != ""})


def _json_split(s):
    """Model of the other splitter: every element, trimmed, repeats kept."""
    return [] if s is None else [i.strip(" ") for i in s.split(",")]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="AB ,", max_size=8)), min_size=1,
                max_size=10))
def test_splitters_match_models(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    rows = df.select("c", C.distinct_nonempty_items(F.col("c")).alias("d"),
                     C.all_items(F.col("c")).alias("a")).collect()
    for r in rows:
        assert sorted(r.d or []) == _recursive_split(r.c)
        assert (r.a or []) == _json_split(r.c)


def test_splitter_fixtures(spark):
    # M14, M15, M16
    df = spark.createDataFrame([("A,,B,",), ("A,A",), (None,), ("",), (" Biryani , Indian",)],
                               "c string")
    got = [(sorted(r.d or []), r.a) for r in
           df.select(C.distinct_nonempty_items(F.col("c")).alias("d"),
                     C.all_items(F.col("c")).alias("a")).collect()]
    assert got == [(["A", "B"], ["A", "", "B", ""]), (["A"], ["A", "A"]), ([], None),
                   ([], [""]), (["Biryani", "Indian"], ["Biryani", "Indian"])]


def test_dense_key_follows_the_order_after_an_offset(spark, tmp_path):
    df = spark.range(2000).select((F.col("id") * 31 % 2000).alias("v")).repartition(7)
    got = {(r.v, r.k) for r in with_dense_key(df, [F.col("v").desc()], "k", str(tmp_path), 70).collect()}
    assert got == {(v, 70 + 2000 - v) for v in range(2000)}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]),
                          st.text(alphabet="xyz", min_size=1, max_size=3),
                          st.integers(0, 5)), min_size=1, max_size=60, unique_by=lambda t: t[:2]))
def test_top_n_equals_brute_force(spark, rows):
    from thalimart.operators.topk import top_n_per_group
    df = spark.createDataFrame(rows, "g string, item string, n int")
    got = sorted((r.g, r.item, r._rank) for r in top_n_per_group(
        df, ["g"], [F.col("n").desc(), F.col("item").asc()], 3).collect())
    want = []
    for g in {r[0] for r in rows}:
        ranked = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))[:3]
        want += [(g, item, i + 1) for i, (_, item, _) in enumerate(ranked)]
    assert got == sorted(want)
