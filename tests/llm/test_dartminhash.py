"""DartMinHash classes against all pairs, and properties of the signatures."""

import random

import numpy as np
import pytest

from thalimart.llm import dartminhash as D


def brute_force(texts: list[str | None], threshold: float = D.THRESHOLD) -> list[int]:
    """Class of every text (index of its first member) over all pairs."""
    root = list(range(len(texts)))

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    def runs(t: str) -> dict:
        found = D._WORD.findall(t.lower())
        out: dict = {}
        for i in range(max(len(found) - D.SHINGLE_WORDS + 1, min(1, len(found)))):
            key = tuple(found[i:i + D.SHINGLE_WORDS])
            out[key] = out.get(key, 0) + 1
        return out

    sets = [runs(t) if t is not None else None for t in texts]
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a is None or b is None:
                continue
            shared = sum(min(n, b[x]) for x, n in a.items() if x in b)
            whole = sum(a.values()) + sum(b.values()) - shared
            if texts[i] == texts[j] or (whole and shared / whole >= threshold):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return [top(i) for i in range(len(texts))]



def check(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, tid string")
    got = {r.doc_id: r.class_id for r in D.classes(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute_force(texts)


def made(rng, n):
    return [rng.choice("abcdefghijklmnop") + rng.choice("aeiou") + str(rng.randrange(300)) for _ in range(n)]


def edited(rng, found, n):
    found = list(found)
    for _ in range(n):
        found[rng.randrange(len(found))] = "new" + str(rng.randrange(10**6))
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(spark, seed):
    rng = random.Random(seed)
    texts = [None, None, "", "", "!!", "!!", "one two", "One, two!", "a b c d", "word " * 400, "word " * 390, "word " * 200]
    for _ in range(12):
        base = made(rng, rng.randrange(30, 300))
        texts += [" ".join(base)] * rng.randrange(1, 4)
        for _ in range(rng.randrange(0, 8)):
            base = edited(rng, base, rng.randrange(0, 6))  # chains: each near the one before
            texts.append(" ".join(base))
    shared = made(rng, 150)
    texts += [" ".join(shared + made(rng, rng.choice([20, 40, 150]))) for _ in range(25)]
    rng.shuffle(texts)
    check(spark, texts)


def test_empty_table_and_repeated_or_null_ids(spark):
    schema = "doc_id long, text string, did int"
    assert D.classes(spark.createDataFrame([], schema)).collect() == []
    rows = [(5, "x y z a b c", 1), (5, "x y z a b c", 2), (None, "x y z a b c", 3), (None, "other words here now five", 4), (7, None, 5), (None, None, 6)]
    got = sorted(map(str, (tuple(r) for r in D.classes(spark.createDataFrame(rows, schema)).collect())))
    assert got == sorted(map(str, [(5, 5, True), (5, 5, True), (None, 5, False), (None, None, False), (7, 7, True), (None, None, False)]))


def test_signature_agreement_estimates_weighted_jaccard():
    rng = np.random.default_rng(3)
    k = 1024
    run = rng.integers(1, 2**63, 60).astype(np.uint64)
    run.sort()
    a, b = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
    owner = np.repeat([0, 1], 60)
    sig = D.signatures(owner, np.r_[run, run], np.r_[a, b], 2, k)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 4 * (want * (1 - want) / k) ** 0.5
    assert (sig > 0).all()


def test_single_run_and_heavy_weight_fill_every_coordinate():
    sig = D.signatures(np.array([0, 1]), np.array([5, 5], np.uint64), np.array([1, 100_000]), 2, 96)
    assert (sig != 0).all()


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 340)]
    df = spark.createDataFrame([(bytes([a // 256, a % 256]), bytes([b // 256, b % 256])) for a, b in pairs if a != b], "a binary, b binary")
    got = {int.from_bytes(r.v): int.from_bytes(r.root) for r in D.components(df).collect()}
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        if a != b:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    assert got == {v: top(v) for v in root}


def test_planted_documents(spark):
    import duckdb
    rows = duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet' order by doc_id").fetchall()
    check(spark, [r[0] for r in rows])


def test_representatives_keep_one_whole_row_of_each_class(spark):
    schema = "doc_id long, text string, tid string, n int"
    rows = [(5, "x y z a b c", "p", 1), (5, "x y z a b c", "q", 2), (6, "X y z a b c", "r", 3), (None, "x y z a b c", "s", 4),
            (None, "other words here now five", "t", 5), (None, "other words here now five", "u", 6), (7, None, "v", 7), (7, None, "w", 8),
            (8, None, "x", 9), (9, "", "y", 10), (10, "", "z", 11), (11, "alone", "a", 12)]
    got = sorted((tuple(r) for r in D.representatives(spark.createDataFrame(rows, schema)).collect()), key=lambda r: r[3])
    assert got == [rows[i] for i in (0, 4, 6, 8, 9, 11)]
    assert D.representatives(spark.createDataFrame([], schema)).collect() == []
