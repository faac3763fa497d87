"""Streaming BPE against the tokenizers library, and its stream invariants."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from thalimart.llm import bpe_stream as B

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPEC = open(PATH, encoding="utf-8").read()
LIB = Tokenizer.from_file(PATH)

TEXTS = [
    "", " ", "  a  b\n\n c", "don't 're 'S ''s", "x<|endoftext|>  y <|endoftext|><|endof", "a\x1cb \x1c c\x85d",
    "naïve façade Größe ¿qué? ½ ² ٣ 漢字かな 🙂🙂 é", "　  tab\t\tend ", "a" * 9000, " " * 9000 + "x",
    "\n" * 5000 + "y", "!?" * 4000 + "'s", "9" * 7000, "ab" * 5000 + " <|endoftext|> " + "z" * 4100,
    "the quick brown fox " * 2000, "​﻿͸x", "<|endoftext", "'", "'r", " '" + "l" * 3000,
]


def lib(text):
    return LIB.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_same_ids_and_text_as_the_library(text):
    ids = B.encode(SPEC, text).tolist()
    assert ids == lib(text)
    assert B.decode(SPEC, ids) == LIB.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("seed", range(30))
def test_any_cut_of_the_stream_gives_the_same_ids(seed):
    rng = random.Random(seed)
    alphabet = ["a", "e", "th", " ", "  ", "\n", "'s", "'", "<|endoftext|>", "<|", "|>", "9", "é", "漢", "!", "ing", " the", "aaaa" * 900, " " * 2500, "!" * 2300]
    text = "".join(rng.choice(alphabet) for _ in range(60))
    coder, out, at = B.Encoder(*B.load(SPEC)), [], 0
    while at < len(text):
        step = rng.choice([1, 2, 3, 7, 50, 3000])
        out.append(coder.feed(text[at:at + step]))
        at += step
    out.append(coder.finish())
    assert np.frombuffer(b"".join(out), "<u4").tolist() == lib(text)


def test_long_runs_keep_bounded_state():
    merges, _ = B.load(SPEC)
    assert 8 <= merges.lookahead <= 4096
    rng = random.Random(7)
    for letters in ("a", "ab", "theing", " "):
        run = B.RunTransducer(merges)
        data = "".join(rng.choice(letters) for _ in range(40_000)).encode()
        out = []
        for at in range(0, len(data), 777):
            out += run.feed(data[at:at + 777])
            assert len(run.buffer) < 2 * run.block
        assert out + run.finish() == merges.merge(data)


def test_improper_merge_list_is_refused():
    import json
    spec = json.loads(SPEC)
    spec["model"]["merges"] = [["Ġth", "e"], ["Ġ", "t"]]
    with pytest.raises(ValueError):
        B.MergeList(json.dumps(spec))


def test_decoder_replaces_broken_bytes_like_the_library():
    rng = random.Random(1)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(1, 12))]
        coder = B.Decoder(B.load(SPEC)[0])
        got = "".join(coder.feed(np.array([i], "<u4").tobytes()) for i in ids) + coder.finish()
        assert got == LIB.decode(ids, skip_special_tokens=False)


def test_query_rows(spark):
    rows = [(1, "Hello world", "x"), (None, None, "y"), (3, "", None), (3, "", None), (4, "é" * 70_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted((tuple(r) for r in B.round_trip(docs, PATH).collect()), key=str)
    want = []
    for d, t, _ in rows:
        ids = lib(t or "")
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert B.round_trip(docs.limit(0), PATH).collect() == []
    kept = {r.doc_id: r.token_ids for r in B.token_ids(docs, PATH).collect()}
    assert kept[1] == lib("Hello world")
