"""License matches against an exact search of all windows."""

import re

import pytest

from thalimart.llm import license_scan as L


def words(text):
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def exact(texts):
    """Best containment per (id, license) over regions that begin anywhere."""
    out = {}
    for i, text in texts:
        own = words(text or "")
        for name, _, template in L.template_rows():
            n = len(template)
            want = {tuple(template[k:k + 3]) for k in range(n - 2)}
            runs = [tuple(own[k:k + 3]) for k in range(len(own) - 2)]
            at = [k for k, r in enumerate(runs) if r in want]
            for k in at:
                have = set(runs[k:k + n + L.ROOM])
                share = len(want & have) / len(want)
                if share >= L.CONTAINMENT:
                    out[i, name] = max(out.get((i, name), 0), share)
    return out


def found(spark, texts):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, license string, band int")
    return {(r.doc_id, r.license): (r.containment, r.first_word) for r in L.scan(docs).collect()}


def test_planted_documents_equal_exact_search(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got, want = found(spark, docs), exact(docs)
    assert {k: round(v[0], 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}
    assert len(got) > 10


@pytest.mark.parametrize("shift", range(6))
def test_every_notice_at_every_offset(spark, shift):
    texts = [(n, " ".join([f"pre{i}" for i in range(shift + 7)] + ["--"] + [L.TEMPLATES[name][k]] + [f"post{i}" for i in range(9)]))
             for n, (name, k, _) in enumerate(L.template_rows())]
    got = found(spark, texts)
    for n, (name, _, template) in enumerate(L.template_rows()):
        assert got[n, name] == (1.0, shift + 7)


def test_edits_and_odd_rows(spark):
    mit = L.TEMPLATES["MIT"][2]
    texts = [(1, mit.replace("software", "program")), (2, "Released under the"), (3, None), (4, ""), (5, "MIT"), (None, "licensed, UNDER cc by-nc 4.0!"),
             (6, "word " * 100_000 + "Released under the MIT License."), (7, "Released under the MIT License. " * 3000), (8, "Permission granted to any person"),
             (9, "x"), (9, "Released under the MIT License.")]
    got = found(spark, texts)
    assert {k: round(v[0], 6) for k, v in got.items()} == {k: round(v, 6) for k, v in exact(texts).items()}
    assert {k[0] for k in got} == {1, None, 6, 7, 9}
    assert got[6, "MIT"] == (1.0, 100_000)
    assert found(spark, []) == {}


def test_only_builtin_expressions_run(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = L.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Nested" not in plan and "Cartesian" not in plan
