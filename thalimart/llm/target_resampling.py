"""Importance resampling towards a target distribution.

A text's features are its words and pairs of consecutive words, hashed into
``BUCKETS`` buckets (crc32). Two arrays count the buckets, one over all documents,
one over all target texts; a third holds the gain of every bucket, the scaled
logarithm of the smoothed target share over the smoothed corpus share. A
document's weight is the mean gain of its features, read from that array. Adding
Gumbel noise of a hash of the id to the weights and taking the highest sums draws
without replacement in proportion to the exponentiated weights; the same seed
always draws the same documents.

The highest scores are found by a distributed LSD radix sort (``radix_sort``) of
the composite key (score falling, id rising): global ranks, no global window and
no task that holds a hot score.

Scale: two passes over the texts, first the counts (a fixed ``BUCKETS`` numbers
per task are shuffled and 10,000 reach the driver), then the weights; only ids and
numbers are written, sorted and joined. Whole texts are read in pieces.

Defined results: null and wordless texts have no feature, weight 0 and are not
drawn; a null id is hashed as an empty text and loses ties against every id; rows
that agree in score and id are ranked in the order in which they are stored; if
all documents, or the target, are empty, the smoothing alone decides; an empty
table gives an empty result. Ids are integers. Columns of the documents may have
any name; a result whose name is taken by a kept column gets a longer one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import arrow_mapped, ascii_words, fresh, quoted, written
from .radix_sort import places

BUCKETS = 10_000
#: Words whose checksums a task remembers.
CACHE_WORDS = 400_000
SCALE = 1000


class _Sums(dict):
    """word -> (its crc32, the word behind a blank)."""

    def __missing__(self, word: bytes) -> tuple[int, bytes]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        out = self[word] = zlib.crc32(word), b" " + word
        return out


def buckets(data: bytes, sums: _Sums) -> Iterator[tuple[np.ndarray, int]]:
    """Feature buckets of a text in UTF-8 piece by piece, and each piece's words."""
    last = None
    for run in ascii_words(data):
        if not run:
            continue
        own = [sums[w] for w in run]
        linked = own if last is None else [last, *own]
        pairs = [zlib.crc32(b[1], a[0]) for a, b in zip(linked, linked[1:], strict=False)]
        yield np.array([a[0] for a in own] + pairs, np.int64) % BUCKETS, len(own)
        last = own[-1]


def _binary(text: Column) -> Column:
    return text.cast("string").cast("binary")


def counted(texts: DataFrame, text: str = "text") -> np.ndarray:
    """How often each bucket occurs in all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros(BUCKETS, np.int64), _Sums()
        for batch in batches:
            for data in batch.column(0).to_pylist():
                for found, _ in buckets(data, sums):
                    total += np.bincount(found, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    some = texts.select(_binary(F.col(quoted(text))).alias("text")).where(F.col("text").isNotNull())
    rows = some.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(SCALE * ln(smoothed target share / smoothed corpus share)) per bucket."""
    share = ((target + 1.0) * float(corpus.sum() + BUCKETS)) / ((corpus + 1.0) * float(target.sum() + BUCKETS))
    return np.floor(SCALE * np.log(share)).astype(np.int64)


def noise(key: Column, seed: int) -> Column:
    """floor of the scaled Gumbel noise that the seed and the id's text hash to."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def weighed(docs: DataFrame, gain: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` and n_words, n_features, weight of every row; the text stays as it is."""
    marks = [fresh(m, docs.columns) for m in ("n_words", "n_features", "weight")]
    schema = StructType([*docs.schema.fields, *(StructField(m, LongType()) for m in marks)])
    at, names = docs.columns.index(text), [*docs.columns, *marks]
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = shared.value, _Sums()
        for batch in batches:
            out = []
            for data in batch.column(at).cast(pa.binary()).to_pylist():
                words = features = total = 0
                for found, n in buckets(data or b"", sums):
                    words, features, total = words + n, features + len(found), total + int(own[found].sum())
                out.append((words, features, total // features if features else 0))
            numbers = [pa.array([x[i] for x in out], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *numbers], names=names)

    return arrow_mapped(docs, run, schema)


def resampled(docs: DataFrame, target: DataFrame, keep: tuple[str, ...] = ("doc_id",), id_column: str = "doc_id",
              percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """The ``keep`` columns of every document, n_features, weight, score and rank:
    of the documents with ``least_words`` words, ``percent`` in a hundred are drawn
    and ranked from 1; the others' rank is null."""
    gain = gains(counted(docs), counted(target))
    sent = list(dict.fromkeys([*keep, id_column, "text"]))
    names = {c: f"c{i}" for i, c in enumerate(sent)}  # whatever they are called
    plain = docs.select([F.col(quoted(c)).alias(n) for c, n in names.items()])
    rows = weighed(plain, gain, names["text"])
    if "text" not in keep:
        rows = rows.drop(names["text"])
    score = F.col("weight") + noise(F.col(names[id_column]), seed)
    scored = written(rows.select("*", score.alias("score"), F.monotonically_increasing_id().alias("at")), "weighed")
    able = scored.where(F.col("n_words") >= least_words).select(
        "at", F.col(names[id_column]).cast("long").alias("id"), (-F.col("score")).alias("falling"))
    place, total = places(able, "at", ["id", "falling"])
    drawn = place.where(F.col("place") < percent * total // 100).select("at", (F.col("place") + 1).alias("rank"))
    return scored.join(drawn, "at", "left").select(
        *(F.col(names[c]).alias(c) for c in keep),
        *(F.col(m).alias(fresh(m, keep)) for m in ("n_features", "weight", "score", "rank")))
