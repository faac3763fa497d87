"""LIKE patterns as an index join against brute force."""

from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from thalimart.operators.substring_match import first_like_match

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _like(text, pattern):
    parts = "".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in pattern.translate(FOLD))
    return re.search(f"(?s){parts}", text.translate(FOLD)) is not None


def _brute(texts, keyed):
    return {t: min(k for p, k in keyed if _like(t, p)) for t in texts if any(_like(t, p) for p, _ in keyed)}


def _found(spark, texts, keyed):
    rows = first_like_match(spark.createDataFrame([(t,) for t in texts], "city string"), "city",
                            spark.createDataFrame(keyed, "city string, k long"), "city", "k")
    assert not any(x in rows._jdf.queryExecution().executedPlan().toString() for x in ("NestedLoop", "Cartesian"))
    return {r.city: r.k for r in rows.collect()}


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(st.text(alphabet="abAB%_\\é ", max_size=7), min_size=1, max_size=10),
       pats=st.lists(st.text(alphabet="abAB%_\\é", max_size=5), min_size=1, max_size=7))
def test_like_equals_brute_force(spark, texts, pats):
    keyed = [(p, i + 1) for i, p in enumerate(pats)]
    assert _found(spark, texts, keyed) == _brute(texts, keyed)


def test_wildcards_alone_nulls_and_no_patterns(spark):
    texts = ["", "a", "ab\nc", "New York"]
    keyed = [("____", 5), ("%", 9), ("_", 7), ("w_y%k", 2), ("b%c", 1)]
    assert _found(spark, texts, keyed) == _brute(texts, keyed)
    assert _found(spark, [*texts, None], [(None, 1)]) == {}
    assert _found(spark, texts, [("%%", 3)]) == dict.fromkeys(texts, 3)
