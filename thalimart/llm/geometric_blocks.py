"""Ranked lexical search over posting lists cut into geometric blocks.

Scores are sums over an item's terms (repeats included) of the term's weight and
the saturated, length-normalised frequency of the term in the document, all in
integers. The search is exact: what is skipped provably cannot be among the best.

1. Forward rows. Every text is cut into terms once; a row keeps the number of its
   terms and the frequencies of the terms that the items ask for. The same rows
   give the number of documents, all terms, and each asked term's document count.
2. Shards. A task takes its forward rows some thousand at a time and builds their
   posting lists. A list is cut into blocks by similarity of the documents: their
   weighted vectors are projected to a few dimensions, some documents of the list
   become centres, every other one joins the centre it is nearest to. A block
   stores the coordinatewise maximum of its documents' vectors.
3. Bounds. An item's product with a block's summary is at least every score in the
   block. A block is skipped only if that bound is below the item's threshold, the
   k-th best score known so far; so are whole lists whose largest contributions
   together stay below it. Documents of the other blocks are scored exactly.
4. The tasks' best k of each item meet in two steps, first in salted groups.

A sixty-fourth of the forward rows is searched first; the k-th best scores there
are valid thresholds for all tasks, since a part's k-th best is never above the
whole's. Every row is in the second search.

Scale: the texts are read once per block of items (``ITEMS`` items or
``ITEM_WORDS`` words, the only data that is broadcast); a shard is bounded by
cells, a task keeps k rows an item, and no group grows with the data.

Defined results: null and termless texts are no documents; items without terms,
or whose terms no document has, have no rows; every row of the items is an item of
its own, rows that repeat an id give a list each; equal scores rank by id, null
last; repeated documents each take a rank; empty tables give an empty result;
other columns, of any name, are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .common import arrow_mapped, ascii_words, quoted, written

ITEMS, ITEM_WORDS = 256, 1 << 14
#: Cells of a shard's matrix (documents x asked terms), and its most documents.
CELLS, SHARD_DOCS = 1 << 23, 4096
#: Documents of a block on average; dimensions of the projection.
BLOCK_DOCS, DIMENSIONS = 32, 16
#: Bounds are doubles, scores integers.
SLACK = 1 + 1e-9
#: One of so many forward rows is searched first; groups of the first merge.
SEEDS, SALTS = 64, 64


@dataclass
class Items:
    """A block of items: bounded by ITEMS and ITEM_WORDS (one item at least)."""

    ids: list = field(default_factory=list)
    terms: list[Counter] = field(default_factory=list)
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    words: int = 0

    def add(self, item_id, text: str) -> None:
        own = Counter(self.vocabulary.setdefault(w, len(self.vocabulary)) for run in ascii_words(text.encode()) for w in run)
        if own:
            self.ids.append(item_id)
            self.terms.append(own)
            self.words += sum(own.values())

    def full(self) -> bool:
        return len(self.ids) >= ITEMS or self.words >= ITEM_WORDS


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[Items]:
    block = Items()
    rows = items.select(F.col(quoted(item_id)), F.col(quoted(text))).where(F.col(quoted(text)).isNotNull())
    for own_id, own_text in rows.toLocalIterator():
        block.add(own_id, own_text)
        if block.full():
            yield block
            block = Items()
    if block.ids:
        yield block


def forward(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n (terms of the text), terms and tfs (of the vocabulary) of every
    document with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema[doc_id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for batch in batches:
            sizes, terms, tfs, cuts = [], [], [], [0]
            for data in batch.column(1):
                n, parts = 0, []
                for words in ascii_words(data.as_py()):
                    n += len(words)
                    found = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
                    parts.append(found[found >= 0])
                own, tf = np.unique(np.concatenate(parts) if parts else np.empty(0, np.int32), return_counts=True)
                sizes.append(n)
                terms.append(own)
                tfs.append(tf)
                cuts.append(cuts[-1] + len(own))
            lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(x) if x else [], t))
                     for x, t in ((terms, pa.int32()), (tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], names=["id", "n", "terms", "tfs"])

    rows = docs.select(F.col(quoted(doc_id)), F.col(quoted(text)).cast("string").cast("binary").alias("text"))
    schema = StructType([StructField("id", kind)]).add("n", LongType()).add("terms", ArrayType(IntegerType())).add("tfs", ArrayType(LongType()))
    return arrow_mapped(rows.where(F.col("text").isNotNull()), run, schema).where("n > 0")


@dataclass
class Corpus:
    """What scoring needs beside a document's own row."""

    documents: int
    words: int
    weights: np.ndarray  # by term

    def impacts(self, n: np.ndarray, owner: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Saturated frequencies of postings of documents with n terms."""
        m = 100 - 25 + (25 * n * self.documents) // self.words
        return (1_000_000_000 * tf) // (1000 * tf + 12 * m[owner])


def corpus_of(rows: DataFrame, terms: int) -> Corpus:
    documents, words = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(terms, np.int64)
    for term, n in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a term asked for
        df[term] = n
    return Corpus(documents, words, np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.int64))


class Searcher:
    """Searches shards one after the other and keeps each item's best k."""

    def __init__(self, items: list[Counter], corpus: Corpus, floors: np.ndarray, k: int):
        self.corpus, self.k = corpus, k
        self.floors = np.maximum(floors, 1)  # scores are above 0
        self.best: list[list[tuple[int, bool, object]]] = [[] for _ in items]
        self.columns = [np.array(sorted(own), np.int64) for own in items]
        self.factors = [np.array([own[t] for t in sorted(own)], np.int64) * corpus.weights[sorted(own)] for own in items]
        self.weight = np.zeros((len(corpus.weights), len(items)))
        for q, (cols, factor) in enumerate(zip(self.columns, self.factors, strict=True)):
            self.weight[cols, q] = factor
        signs = np.random.default_rng(13).integers(0, 2, (len(corpus.weights), DIMENSIONS)) * 2.0 - 1
        self.signs = (signs * corpus.weights[:, None]).astype(np.float32)
        self.counts = Counter()

    def shard(self, ids: list, n: np.ndarray, cuts: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> None:
        owner = np.repeat(np.arange(len(ids)), np.diff(cuts))
        impact = self.corpus.impacts(n, owner, tfs)
        matrix = np.zeros((len(ids), len(self.corpus.weights)), np.float32)  # impacts are at most 10^6: exact
        matrix[owner, terms] = impact
        order = np.argsort(terms, kind="stable")
        ends = np.searchsorted(terms[order], np.arange(len(self.corpus.weights) + 1))
        lists = owner[order]
        asked = self._essential(matrix.max(0))
        place = matrix @ self.signs
        place /= np.linalg.norm(place, axis=1, keepdims=True) + 1e-9
        open_ = np.zeros((len(self.best), len(ids)), bool)
        for t in np.flatnonzero(asked.any(1)):
            docs = lists[ends[t]:ends[t + 1]]
            if len(docs):
                self._list(matrix, place, docs, np.flatnonzero(asked[t]), open_)
        for q in np.flatnonzero(open_.any(1)):
            self._score(q, matrix, np.flatnonzero(open_[q]), ids)

    def _essential(self, most: np.ndarray) -> np.ndarray:
        """(term, item): lists to be opened. The others of an item, taken together,
        cannot lift a document to the threshold."""
        out = np.zeros(self.weight.shape, bool)
        for q, (cols, factor) in enumerate(zip(self.columns, self.factors, strict=True)):
            bound = factor * most[cols].astype(np.float64)
            rising = np.argsort(bound, kind="stable")
            out[cols[rising[np.cumsum(bound[rising]) * SLACK >= self.floors[q]]], q] = True
        return out

    def _list(self, matrix: np.ndarray, place: np.ndarray, docs: np.ndarray, items: np.ndarray, open_: np.ndarray) -> None:
        """Cuts a posting list into blocks and opens, per item, those whose summary
        allows a score at the threshold."""
        centres = docs[:: BLOCK_DOCS]
        nearest = (place[docs] @ place[centres].T).argmax(1)
        order = np.argsort(nearest, kind="stable")
        docs = docs[order]
        begins = np.flatnonzero(np.r_[True, np.diff(nearest[order]) > 0])
        cols = np.unique(np.concatenate([self.columns[q] for q in items]))
        summary = np.maximum.reduceat(matrix[np.ix_(docs, cols)], begins, axis=0)
        bounds = summary.astype(np.float64) @ self.weight[np.ix_(cols, items)]
        keep = bounds * SLACK >= self.floors[items]
        self.counts.update(blocks=keep.size, skipped=int(keep.size - keep.sum()))
        member = np.repeat(np.arange(len(begins)), np.diff(np.r_[begins, len(docs)]))
        hit, item = np.nonzero(keep[member])
        open_[items[item], docs[hit]] = True

    def _score(self, q: int, matrix: np.ndarray, docs: np.ndarray, ids: list) -> None:
        scores = matrix[np.ix_(docs, self.columns[q])].astype(np.int64) @ self.factors[q]
        self.counts.update(scored=len(docs))
        good = scores >= self.floors[q]
        found = [(-int(s), ids[d] is None, ids[d]) for s, d in zip(scores[good], docs[good], strict=True)]
        if found:
            self.best[q] = sorted([*self.best[q], *found], key=lambda r: (r[0], r[1], r[2] if not r[1] else 0))[:self.k]
            if len(self.best[q]) == self.k:
                self.floors[q] = max(self.floors[q], -self.best[q][-1][0])


def _shards(batches: Iterator[pa.RecordBatch], terms: int) -> Iterator[tuple]:
    size = max(1, min(SHARD_DOCS, CELLS // max(1, terms)))
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        while sum(map(len, held)) >= size:
            rows = pa.Table.from_batches(held)
            yield _columns(rows.slice(0, size))
            held = rows.slice(size).combine_chunks().to_batches()
    if sum(map(len, held)):
        yield _columns(pa.Table.from_batches(held))


def _columns(rows: pa.Table) -> tuple:
    ids, n, terms, tfs = (c.combine_chunks() for c in rows.columns)
    offsets = terms.offsets.to_numpy()
    return ids.to_pylist(), n.to_numpy(), offsets - offsets[0], terms.flatten().to_numpy(), tfs.flatten().to_numpy()


def _search(rows: DataFrame, items: list[Counter], corpus: Corpus, floors: np.ndarray, k: int) -> DataFrame:
    """q, score, id: the best k of each item."""
    shared = rows.sparkSession.sparkContext.broadcast((items, corpus, floors))
    id_type = rows.schema["id"].dataType
    kind = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(*shared.value, k)
        for own in _shards(batches, len(shared.value[1].weights)):
            searcher.shard(*own)
        best = [(q, -score, own_id) for q, found in enumerate(searcher.best) for score, _, own_id in found]
        q, score, ids = zip(*best, strict=True) if best else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(score, pa.int64()), pa.array(ids, kind)], names=["q", "score", "id"])

    schema = StructType([StructField("q", LongType()), StructField("score", LongType()), StructField("id", id_type)])
    found = arrow_mapped(rows, run, schema).withColumn("salt", F.spark_partition_id() % SALTS)
    rank = [F.desc("score"), F.asc_nulls_last("id")]
    for group in (["q", "salt"], ["q"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*rank))).where(F.col("rank") <= k)
    return found.select("q", "rank", "id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` best documents."""
    spark, out = docs.sparkSession, None
    kinds = StructType([StructField("q", LongType()), StructField(item_id, items.schema[item_id].dataType)])
    for block in _blocks(items, item_id, text):
        rows = written(forward(docs, block.vocabulary, doc_id, text), "forward")
        corpus = corpus_of(rows, len(block.vocabulary))
        if not corpus.documents:
            break
        floors = np.zeros(len(block.ids), np.int64)
        seeds = rows.where(F.pmod(F.xxhash64("id", "n"), F.lit(SEEDS)) == 0)
        for q, score in _search(seeds, block.terms, corpus, floors, k).where(F.col("rank") == k).select("q", "score").collect():
            floors[q] = score
        names = spark.createDataFrame(list(enumerate(block.ids)), kinds)
        found = _search(rows, block.terms, corpus, floors, k).join(F.broadcast(names), "q").select(
            F.col(quoted(item_id)), F.col("rank").cast("int").alias("rank"), F.col("id").alias(doc_id), "score")
        found = written(found, "ranked")
        out = found if out is None else out.unionByName(found)
    empty = StructType([kinds[1]]).add("rank", IntegerType()).add(StructField(doc_id, docs.schema[doc_id].dataType)).add("score", LongType())
    return spark.createDataFrame([], empty) if out is None else out
