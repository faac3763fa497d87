"""Token files against the tokenizers library, and what their metadata prunes."""

import random
import zlib

import numpy as np
import public_tokenizers
from pyarrow import orc
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from thalimart.llm import orc_tokens as T

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*LIB.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_path_equals_the_library():
    words = T.load(open(PATH, encoding="utf-8").read())
    rng = random.Random(4)
    pool = ["the", " ", "  ", "\n", "'S", "'re", "Don't", "ÉTÉ", "é", "ß", "²", "½", "İ", "9a", "a_b", "--", "!?", "\x1c", "\x85", "\xa0", "漢字", "Σ", "ΑΣ ", "<|endoftext|>", "<|startoftext|>x", "ǅ", "ŉ", "ñ", "🙂", "…", "ª"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(12))) for _ in range(3000)]
    for t in texts:
        assert np.frombuffer(words.text(t), "<u4").tolist() == ids_of(t)[:-1], repr(t)


def test_every_distinct_word_is_looked_up_once():
    words = T.Words(open(PATH, encoding="utf-8").read())
    asked = []

    class Known(dict):
        def get(self, word):
            asked.append(word)
            return super().get(word)

    words.words = Known()
    texts = ["Hello, hello. HELLO it's 漢字, '漢字,' é" * 50, "", "hello, (Hello) 1 É"]
    assert [np.frombuffer(x, "<u4").tolist() for x in words.texts(texts)] == [ids_of(t)[:-1] for t in texts]
    assert len(asked) == len(set(asked)) == len(words.words) == len(set(words.words))


def test_every_latin_character_beside_others():
    words = T.Words(open(PATH, encoding="utf-8").read())
    rng = random.Random(5)
    marks = ["'", "'s", "'Re", "''", "<", "|", "a", "É", "7", "-", "\u0301", "\U0001f642", "ſ", ""]
    texts = [a + chr(i) + b + chr(i).upper() + a + " " + b + chr(i)
             for i in range(0x250) for a, b in [rng.sample(marks, 2) for _ in range(4)]]
    assert [np.frombuffer(x, "<u4").tolist() for x in words.texts(texts)] == [ids_of(t)[:-1] for t in texts]
    alone = [chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000]
    assert [np.frombuffer(x, "<u4").tolist() for x in words.texts(alone)] == [ids_of(t)[:-1] for t in alone]


def check(spark, rows, folder):
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, file int")
    T.write_tokens(docs, folder, PATH)
    got = [tuple(r) for r in T.digests(spark, folder).collect()]
    want = sorted((r[0] if r[0] is not None else -(1 << 63), len(ids_of(r[1])), crc(ids_of(r[1]))) for r in rows)
    order = sorted(got, key=lambda r: r[1])
    assert sorted((d if d is not None else -(1 << 63), n, c) for d, _, n, c in got) == want
    assert [s for _, s, _, _ in order] == [0, *np.cumsum([n for _, _, n, _ in order]).tolist()][:len(order)]
    assert [d for d, *_ in order] == sorted((d for d, *_ in order), key=lambda d: (d is not None, d))


def test_odd_rows(spark, tmp_path):
    rows = [(3, "Hello, World!", "x", 1), (1, None, "x", 1), (None, "null id", None, None), (2, "", "x", 1), (3, "Hello, World!", "x", 1),
            (3, "another text of one id", "x", 1), (-5, "Ünïcode é", "x", 1), (9, "long text " * 50_000, "x", 1)]
    check(spark, rows, str(tmp_path / "a"))
    check(spark, [], str(tmp_path / "b"))


def test_documents_and_metadata(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    folder = str(tmp_path / "t")
    T.write_tokens(docs, folder, PATH)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in T.digests(spark, folder).collect()}
    start = 0
    for d, text in sorted(rows):
        ids = ids_of(text)
        assert got[d] == (start, len(ids), crc(ids))
        start += len(ids)
    one = T.read_tokens(spark, folder, F.col("doc_id") == 77)
    assert "EqualTo(doc_id,77)" in one._jdf.queryExecution().toString()
    assert [r.ids for r in one.collect()] == [ids_of(dict(rows)[77])]
    files = [orc.ORCFile(f) for f in (tmp_path / "t").glob("part-*.orc")]
    assert sum(f.nrows for f in files) == len(rows)
    assert all(f.row_index_stride == T.INDEX_ROWS for f in files)
