"""Token ids as ORC files in document order.

Spark's ORC writer stores the ids with integer run-length encoding in stripes of
``STRIPE_BYTES``, a row index entry every ``INDEX_ROWS`` rows, and Bloom filters on
doc_id in it. Documents are in ascending doc_id order over the files, so a reader
that asks for a range or for single documents skips files by their footers, stripes
and row groups by their statistics and filters, and a full read splits by stripe.

Every row holds its document's ids, its file's number, and how many ids lie before
it in that file. The documents before a file are summed from one narrow row per
file, so a document's place in the whole stream needs no global sort and no pass
over the ids.

Tokens. The model of the tokenizers library encodes the distinct words of many texts
and the results are remembered per process. Words are cut as the library's normalizer
and pre-tokenizer would (below U+0250 every text is in NFC); pieces where that could
differ (beyond U+024F, also in lower case, or with a special token) and texts with
unusual control characters go to it whole.

Defined results: a null text has no ids but the end id; documents with equal ids lie
next to each other in the order of their texts' hashes and are separate rows; null
ids come first; very long texts are one row each; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe_stream import latin_classes
from .common import partitions_for, slices, utf8_bytes

END_ID = 2
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1000
#: Bytes of text that one file holds on average.
FILE_BYTES = 64 << 20
BATCH_IDS, CACHE_WORDS = 500_000, 900_000
#: Bytes of text that are cut and looked up together.
BATCH_TEXT = 4 << 20
FILE_SCHEMA = "doc_id bigint, file int, before bigint, n bigint, ids array<int>"

#: White space to Python but not to the library: such texts go to it whole.
_CONTROL = "\x1c\x1d\x1e\x1f"
#: Kinds of a UTF-16 unit. What lies beyond Latin, and a letter whose lower case does
#: or is two characters, is left to the library, and so is the piece that holds it.
SPACE, LETTER, NUMBER, SIGN, OTHER = range(5)
_LATIN_END = 0x250
#: What follows the apostrophe of a contraction.
_SHORT = ("s", "t", "m", "d", "re", "ve", "ll")


def _units() -> tuple[np.ndarray, np.ndarray]:
    """The kind and the lower case of every UTF-16 unit."""
    kinds, lower = np.full(1 << 16, OTHER, np.uint8), np.arange(1 << 16, dtype="<u2")
    letters, numbers = (re.compile(f"[{c}]") for c in latin_classes())
    for i in range(1 << 16):
        c = chr(i)
        if c.isspace():
            kinds[i] = SPACE
        elif i < _LATIN_END and len(c.lower()) == 1 and ord(c.lower()) < _LATIN_END:
            kinds[i] = LETTER if letters.match(c) else NUMBER if numbers.match(c) else SIGN
            lower[i] = ord(c.lower())
    return kinds, lower


_KINDS, _LOWER = _units()


def _whole_pieces(units: np.ndarray, kinds: np.ndarray) -> np.ndarray | None:
    """Which units lie in pieces (runs without white space) that go to the library
    as they are: with a character left to it or a special token's first two."""
    odd = kinds == OTHER
    odd[:-1] |= (units[:-1] == ord("<")) & (units[1:] == ord("|"))
    if not odd.any():
        return None
    black = kinds != SPACE
    piece = np.cumsum(np.r_[black[0], black[1:] & ~black[:-1]])
    held = np.zeros(int(piece[-1]) + 1, bool)
    held[piece[odd]] = True
    return held[piece] & black


def cut_words(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """The units in lower case, where in them a word begins, and which go to the
    library as they are. Words are cut as its pre-tokenizer does: runs of letters,
    single numbers, runs of signs, and contractions where an apostrophe begins a match."""
    kinds = _KINDS[units]
    starts = np.r_[True, kinds[1:] != kinds[:-1]]
    starts |= kinds == NUMBER
    low = _LOWER[units]
    quotes = np.flatnonzero(starts & (units == ord("'")))
    if len(quotes):
        padded = np.r_[low, np.zeros(3, low.dtype)]
        for tail in _SHORT:
            own = quotes[np.all([padded[quotes + 1 + i] == ord(c) for i, c in enumerate(tail)], axis=0)]
            starts[own + 1] = False
            ends = own + 1 + len(tail)
            starts[ends[ends < len(starts)]] = True
    whole = _whole_pieces(units, kinds)
    black = kinds != SPACE
    if whole is not None:
        low = np.where(whole, units, low)
        starts = np.where(whole, np.r_[True, ~black[:-1]], starts)
    return low, starts & black, whole


class Words:
    """Ids of texts as 32-bit little-endian bytes. The library drops white space and
    joins nothing across it, so a text's ids are those of its words. The words of
    many texts are cut and numbered together in columns; every distinct word is looked
    up once, and new ones go to the library many at a time."""

    def __init__(self, spec: str):
        self.library = Tokenizer.from_str(spec)
        self.library.no_padding()
        self.library.no_truncation()
        self.words: dict[bytes, bytes] = {}  # by the word in UTF-16
        self.four = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]
        cut = self.library.pre_tokenizer.pre_tokenize_str  # spells every byte as a character
        self.spelled = {i: "".join(t for t, _ in cut(chr(i))) for i in range(_LATIN_END) if _KINDS[i] not in (SPACE, OTHER)}

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def text(self, text: str) -> bytes:
        return self.texts([text])[0]

    def texts(self, texts: list[str]) -> list[bytes]:
        plain = ["" if any(c in t for c in _CONTROL) else t for t in texts]
        coded = [t.encode("utf-16-le") for t in plain]
        begins = np.cumsum([0, *(len(c) // 2 + 1 for c in coded)])  # a line feed ends each
        units = np.frombuffer(b"\n\0".join([*coded, b""]), "<u2")
        data, cuts = self.ids(units, begins)
        return [bytes(data[a:b]) if t == p else self.whole(t)
                for t, p, a, b in zip(texts, plain, cuts, cuts[1:], strict=False)]

    def ids(self, units: np.ndarray, begins: np.ndarray) -> tuple[memoryview, list[int]]:
        """The ids of all words in a row, and the byte at which each text begins."""
        if not len(units):
            return memoryview(b""), [0] * len(begins)
        low, starts, whole = cut_words(units)
        at = np.flatnonzero(starts)
        black = _KINDS[units] != SPACE
        offsets = np.r_[np.flatnonzero(starts[black]), np.count_nonzero(black)].astype(np.int64) * 2
        column = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(low[black])])
        numbered = column.dictionary_encode()
        keys = numbered.dictionary.to_pylist()
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        values = list(map(self.words.get, keys))
        new = [i for i, v in enumerate(values) if v is None]
        if new:
            odd = set()
            if whole is not None:
                odd = set(column.filter(pa.array(whole[at])).unique().to_pylist())
            self.learn([keys[i] for i in new if keys[i] not in odd], [keys[i] for i in new if keys[i] in odd])
            for i in new:
                values[i] = self.words[keys[i]]
        found = pa.array(values, pa.large_binary()).take(numbered.indices)
        if not len(found):
            return memoryview(b""), [0] * len(begins)
        ends = np.frombuffer(found.buffers()[1], np.int64)[:len(found) + 1]
        return memoryview(found.buffers()[2] or b""), ends[np.searchsorted(at, begins)].tolist()

    def learn(self, new: list[bytes], odd: list[bytes]) -> None:
        tokenize, four, known = self.library.model.tokenize, self.four, self.words
        # in lower case and cut already: the library's model does the rest
        for w, text in zip(new, b"\n\0".join(new).decode("utf-16-le").split("\n") if new else [], strict=True):
            if not (text.isascii() and text.isprintable()):
                text = text.translate(self.spelled)
            known[w] = b"".join([four[t.id] for t in tokenize(text)])
        known.update((w, self.whole(w.decode("utf-16-le"))) for w in odd)


_LOADED: dict[str, Words] = {}


def load(spec: str) -> Words:
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Words(spec)
    return _LOADED[key]


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = END_ID) -> None:
    """doc_id, file, before, ids of every document. The texts are range-partitioned
    by doc_id (documents of one id by a hash of their text, so a frequent id is
    split) and encoded in that order by the tasks that write the files."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    total = own.agg(F.sum(utf8_bytes(F.col("text"))).alias("n")).first().n
    files = max(partitions_for(total, FILE_BYTES), spark.sparkContext.defaultParallelism)
    tie = F.xxhash64("text")
    ranged = own.repartitionByRange(files, "doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, words, before = TaskContext.get().partitionId(), load(spec.value), 0
        held: list[tuple[int | None, bytes]] = []

        def out() -> pa.RecordBatch:
            nonlocal before
            sizes = np.array([len(x) // 4 for _, x in held], np.int64)
            starts = before + np.r_[0, np.cumsum(sizes)]
            before = int(starts[-1])
            ids = np.frombuffer(b"".join(x for _, x in held), "<i4")
            batch = pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in held], pa.int64()), pa.array(np.full(len(held), part, np.int32)), pa.array(starts[:-1]),
                 pa.array(sizes), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(ids))],
                names=["doc_id", "file", "before", "n", "ids"])
            held.clear()
            return batch

        waiting = 0
        for batch in batches:
            weights = [n or 0 for n in pc.binary_length(batch.column(1)).to_pylist()]
            for begin, end in slices(weights, BATCH_TEXT):
                texts = [t or "" for t in batch.column(1)[begin:end].to_pylist()]
                for doc_id, ids in zip(batch.column(0)[begin:end].to_pylist(), words.texts(texts), strict=True):
                    held.append((doc_id, ids + tail))
                    waiting += len(held[-1][1]) // 4
                    if waiting >= BATCH_IDS:
                        yield out()
                        waiting = 0
        if held:
            yield out()

    (ranged.mapInArrow(run, FILE_SCHEMA)
     .write.option("orc.stripe.size", str(STRIPE_BYTES)).option("orc.row.index.stride", str(INDEX_ROWS))
     .option("orc.bloom.filter.columns", "doc_id").option("orc.create.index", "true").option("compression", "zstd").orc(path))


def read_tokens(spark: SparkSession, path: str, wanted: Column | None = None) -> DataFrame:
    """The rows of the files; ``wanted`` (over doc_id) is pushed into the ORC reader."""
    table = spark.read.schema(FILE_SCHEMA).orc(path)
    return table if wanted is None else table.where(wanted)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(4)
            offsets = lists.offsets.to_numpy()
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "file", "before", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path)
    counts = rows.groupBy("file").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))  # a row per file
    found = rows.mapInArrow(run, "doc_id bigint, file int, before bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(F.broadcast(base), "file").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
