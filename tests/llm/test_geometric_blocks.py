"""The exact search against a plain one over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from thalimart.llm import geometric_blocks as G

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _terms(text):
    return WORD.findall((text or "").translate(SMALL))


def _model(docs, items, k=20):
    own = [(i, Counter(_terms(t)), len(_terms(t))) for i, t in docs]
    own = [x for x in own if x[2]]
    total, words = len(own), sum(x[2] for x in own)
    df = Counter(t for _, tf, _ in own for t in tf)
    out = []
    for item, text in items:
        scored = []
        for i, tf, n in own:
            m = 100 - 25 + 25 * n * total // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 12 * m))
                        for t in _terms(text) if tf[t])
            if score > 0:
                scored.append((-score, i is None, i))
        best = sorted(scored, key=lambda r: (r[0], r[1], r[2] or 0))[:k]
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(best, 1)]
    return Counter(out)


def _texts(n, seed, most=60):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["École", "ÉCOLE", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [" ".join(pick.choices(vocabulary, weights, k=pick.randrange(0, most))) + pick.choice(["", ".", " W1 w1-w1"]) for _ in range(n)]


@pytest.mark.parametrize("cells", [1 << 23, 4000])
def test_equals_the_plain_search(spark, monkeypatch, cells):
    monkeypatch.setattr(G, "CELLS", cells)
    docs = [*enumerate(_texts(400, 1)), (None, "w1 w2"), (None, None), (400, ""), (401, "w3 " * 100_000), (7, "w1 w2"), (7, "w1 w2")]
    items = [*enumerate(_texts(25, 2, 30)), (None, "w1 w5 w5"), (3, "w9 unknown"), (99, None), (98, "nothing here"), (97, "?!")]
    got = G.ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                   spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == _model(docs, items)


def test_items_go_in_bounded_blocks(spark, monkeypatch):
    monkeypatch.setattr(G, "ITEMS", 4)
    docs, items = [*enumerate(_texts(80, 3))], [*enumerate(_texts(10, 4, 20))]
    got = G.ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k=5)
    assert Counter(map(tuple, got.collect())) == _model(docs, items, 5)


def test_blocks_are_skipped_and_only_by_their_bounds():
    pick = np.random.default_rng(5)
    topics = [pick.choice(60, 8, False) for _ in range(40)]  # terms occur in several topics
    own = [np.sort(pick.choice(topics[d % 40], 6, False)) for d in range(12_000)]
    cuts = np.arange(0, 6 * len(own) + 1, 6)
    owner, terms, tfs = np.repeat(np.arange(len(own)), 6), np.concatenate(own), pick.integers(1, 5, 6 * len(own))
    n = pick.integers(10, 60, len(own))
    corpus = G.Corpus(len(own), int(n.sum()), np.full(60, 3000))
    items = [Counter({int(t): 1 + i for i, t in enumerate(topics[q][:5])}) for q in range(10)]
    dense = np.zeros((len(own), 60), np.int64)
    dense[owner, terms] = corpus.impacts(n, owner, tfs)
    found = G.Searcher(items, corpus, np.zeros(10, np.int64), 20)
    for part in np.array_split(pick.permutation(len(own)), 4):
        at = np.concatenate([np.arange(cuts[d], cuts[d + 1]) for d in part])
        found.shard(part.tolist(), n[part], np.arange(0, 6 * len(part) + 1, 6), terms[at], tfs[at])
    for q, item in enumerate(items):
        scores = sum(r * 3000 * dense[:, t] for t, r in item.items())
        assert found.best[q] == sorted((-int(s), False, d) for d, s in enumerate(scores) if s > 0)[:20]
    assert found.counts["skipped"] > found.counts["blocks"] // 5
    assert found.counts["scored"] < 10 * len(own) // 2


def test_empty_tables_and_names(spark):
    docs = spark.createDataFrame([(1, "w1 w2", 3)], "`a.b` long, text string, q int")
    items = spark.createDataFrame([("x", "W2", 3)], "item_id string, text string, score int")
    assert [tuple(r) for r in G.ranked(docs, items, doc_id="a.b").collect()] == [("x", 1, 1, 287 * (10 ** 9 // 2200))]
    assert G.ranked(docs.limit(0), items, doc_id="a.b").collect() == []
    none = G.ranked(docs, items.limit(0), doc_id="a.b")
    assert (none.columns, none.collect()) == (["item_id", "rank", "a.b", "score"], [])
