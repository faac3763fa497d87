"""The field against direct recursion and enumeration, and held-out accuracy."""

import itertools
import tracemalloc

import duckdb
import numpy as np
from pyspark.sql import functions as F

from thalimart.llm import crf_langid as C


def test_block_passes_equal_word_by_word_recursion():
    rng = np.random.default_rng(0)
    sizes = np.array([1, 5, 31, 32, 33, 100, 700, 2])
    psi, step = rng.random((sizes.sum(), 3)) + 0.01, np.exp(rng.normal(size=(3, 3)))
    got, at = C.posteriors(psi, sizes, step), 0
    for n in sizes:
        want, _, _ = C._forward_backward(psi[None, at:at + n], step)
        assert np.allclose(got[at:at + n], want[0])
        at += n


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    psi, step = rng.random((4, 2)) + 0.1, rng.random((2, 2)) + 0.1
    score, pairs = np.zeros((4, 2)), np.zeros((2, 2))
    total = 0.0
    for path in itertools.product(range(2), repeat=5):  # the first is the virtual start
        p = 0.5 * np.prod([step[a, b] for a, b in itertools.pairwise(path)]) * np.prod([psi[t, y] for t, y in enumerate(path[1:])])
        total += p
        for t, y in enumerate(path[1:]):
            score[t, y] += p
        for a, b in itertools.pairwise(path):
            pairs[a, b] += p
    post, got_pairs, log_z = C._forward_backward(psi[None], step)
    assert np.allclose(post[0], score / total)
    assert np.allclose(got_pairs, pairs / total)
    assert np.isclose(log_z, np.log(total))


def test_held_out_accuracy_and_code_switching(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = C.fit(docs, C.trained_rows(F.col("doc_id")))
    assert model.languages == ["de", "en", "es", "fr"]
    rows = C.predict(docs, model, ("doc_id", "lang")).where(C.held_out(F.col("doc_id"))).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    text = {lang: duckdb.sql(f"select text from '/root/testdata/sf0.01/documents.parquet' where lang='{lang}' and n_chars between 900 and 4000 order by doc_id limit 1").fetchall()[0][0] for lang in ("en", "de")}
    en, de = C.words(text["en"])[:40], C.words(text["de"])[:40]
    psi = C.Scorer(model).factors(en + de).astype(float)
    post = C.posteriors(psi, np.array([len(en) + len(de)]), np.exp(model.transition))
    named = [model.languages[i] for i in post.argmax(1)]
    assert named[:40].count("en") > 36 and named[40:].count("de") > 36  # words are labelled, not only texts


def test_edge_rows(spark):
    schema = "doc_id long, text string, lang string, score string, lang_pred int"
    rows = [(1, "alpha beta gamma delta " * 5, "x", "a", 1), (2, "rot grun blau gelb " * 5, "y", "b", 2),
            (4, None, "x", "c", 3), (5, "", "x", None, 4), (6, "12 ... 34", "y", "d", 5), (None, "alpha beta", None, "e", 6),
            (7, "rot " * 60_000, None, "f", 7), (7, "rot " * 60_000, None, "f", 7), (8, "z" * 200_000, None, "g", 8)]
    docs = spark.createDataFrame(rows, schema)
    model = C.fit(docs, C.trained_rows(F.col("doc_id")) | F.col("doc_id").isin(1, 2))
    got = [(r.doc_id, r.lang_pred, r.score) for r in C.predict(docs, model).collect()]
    named = {d: p for d, p, _ in got}
    assert len(got) == 9
    assert named[1] == "x" and named[2] == "y" and named[7] == "y" and named[None] == "x"
    assert [x for x in got if x[0] in (4, 5, 6)] == [(4, "und", 0.0), (5, "und", 0.0), (6, "und", 0.0)]
    assert got[6] == got[7]
    nothing = C.fit(docs.where("lang = 'none'"), C.trained_rows(F.col("doc_id")))
    assert nothing is None
    assert {r.lang_pred for r in C.predict(docs, nothing).collect()} == {"und"}
    assert C.predict(docs.limit(0), model).collect() == []


def test_sample_is_drawn_among_rows_with_words_and_from_long_texts(spark):
    schema = "doc_id long, text string, lang string"
    x, y, z = "alpha beta gamma delta ", "rot grun blau gelb ", "uno due tre quattro "
    rows = [(i, x * 1200, "x") for i in range(20)]  # long texts only
    rows += [(i, None if i % 3 else "12 34", "y") for i in range(100, 190)] + [(190, y * 5, "y"), (191, y * 6, "y")]
    rows += [(200, z * 5 + str(i), "z") for i in range(60)] + [(200, z * 9, "z")] * 60  # one id
    rows += [(300, "." * 30_000 + " eins zwei drei " + "7 " * 30_000, "w")]
    docs = spark.createDataFrame(rows, schema)
    model = C.fit(docs, F.col("doc_id").isNotNull(), train_docs=2)
    assert model.languages == ["w", "x", "y", "z"]
    got = {r.doc_id: r.lang_pred for r in C.predict(docs.where("doc_id in (0, 190, 200, 300)"), model).collect()}
    assert got == {0: "x", 190: "y", 200: "z", 300: "w"}
    again = C.fit(docs.repartition(7), F.col("doc_id").isNotNull(), train_docs=2)
    assert (again.weights == model.weights).all() and again.lexicon == model.lexicon
    long = spark.createDataFrame(rows[:1] + [(1, "z" * 50_000, "x")], schema).select(C.sample(F.col("text"))).collect()
    assert set(long[0][0].split()) == set(x.split()) and C.TRAIN_CHARS * 0.9 < len(long[0][0]) <= C.TRAIN_CHARS + C.PIECES
    assert set(long[1][0]) == {"z", "\n"}


def _scorer() -> C.Scorer:
    rng = np.random.default_rng(2)
    weights = rng.normal(size=(C.FEATURES + 4, 4)).astype(np.float32)
    return C.Scorer(C.Model(list("abcd"), weights, np.zeros((4, 4)), {"w7": 2}))


def test_new_words_are_looked_up_part_by_part(monkeypatch):
    found = [f"w{i % 50}" for i in range(120)]
    whole = _scorer().factors(found)
    monkeypatch.setattr(C, "NEW_WORDS", 7)
    assert np.array_equal(_scorer().factors(found), whole)


def test_many_new_words_take_little_memory_at_once():
    scorer, found = _scorer(), [f"strangeword{i}" for i in range(60_000)]
    tracemalloc.start()
    scorer.factors(found)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 80e6
