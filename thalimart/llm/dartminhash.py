"""Near-duplicate detection by DartMinHash signatures and banded joining.

A text is the multiset of its runs of five words (lower-cased word characters;
a text of one to four words is one run); the weight of a run is how often it
occurs. Similarity is the weighted Jaccard index sum(min) / sum(max).

Signatures. Every run x owns a hashed Poisson process of darts on the plane
(weight, rank): in the layers of weight [0,1), [1,2), [2,4), ... darts arrive at
exponential rank steps with the layer's thickness as rate. A text throws the
darts of its runs that fall below the run's weight, up to a rank that gives
about ``k ln k + 2k`` darts whatever the text's length; each dart hashes to one
of k coordinates, and each coordinate keeps its earliest dart. A text with an
empty coordinate throws on to twice the rank. Two texts agree in a coordinate
with probability equal to their weighted Jaccard index.

Joining. ``BANDS`` bands of ``ROWS`` coordinates: a pair at similarity 0.8 meets
in some band with probability 1 - (1 - 0.8^4)^24 > 0.999996. Then

1. texts are collapsed to distinct ones (copies share a row from here on);
2. in every bucket each text is paired with one leader only, the text that meets
   most others in all buckets (a star: as many pairs as rows). Pairs whose
   signatures agree in fewer than 0.6 of the coordinates go (at similarity 0.8
   this has probability 3e-7), the others are verified exactly on whole texts;
3. links are joined into components. A bucket whose texts all lie in the
   component of its leader is done;
4. in the others, texts outside that component are compared with all texts of
   other components, block by block, unless a bound rules the pair out. Bounds:
   sizes; with d the exact distance to the leader, the triangle inequality (1 -
   weighted Jaccard is a metric); and the weight of runs that no other text of
   these buckets has, which can be in no intersection. The bounds are exact: an
   edited copy whose own words take it under 0.8 is compared with few.

So every pair of different texts that meets in a band and reaches the threshold
is a link or lies inside one component already: classes lose nothing to the
stars, and a bucket of many copies costs its rows, not its square.

Defined results: a null text and a text without a word form no link; texts with
no word are classed by equality; repeated rows are copies; a null doc_id is
kept and its class is the smallest non-null id, if any; class ids are the
smallest doc_id of the class; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_task, fresh, mix64, quoted, short_batches, slices, written

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
#: Sketches of a pair at the threshold agree in a share of coordinates no less than
#: the threshold minus this (five standard deviations).
SLACK = 0.2
#: Texts and bytes of a block of a bucket.
BLOCK, BLOCK_BYTES = 256, 8 << 20
#: Stands for a null doc_id inside.
NO_ID = -(1 << 63)
#: Words handled at once and hashed words remembered per process.
BATCH_WORDS, CACHE_WORDS = 150_000, 200_000
#: A short text throws as many darts as a long one: it counts as this many words.
DART_WORDS = 200

_WORD = re.compile(r"\w+")
_U = np.uint64


def _salt(n: int, odd: int) -> np.uint64:
    return _U(n * odd % (1 << 64))


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h
        return h


_HASHES = WordHashes()


def _forget() -> None:
    _HASHES.clear()


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a list of texts: owner, run hash and weight, sorted by owner and hash."""
    found = [_WORD.findall(t.lower()) for t in texts]
    sizes = np.array([len(f) for f in found], np.int64)
    flat = np.fromiter(map(_HASHES.__getitem__, chain.from_iterable(found)), np.uint64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(texts)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))  # words from here to the text's end
    first = left == sizes[owner] if len(flat) else np.zeros(0, bool)
    run, joined = mix64(flat), np.ones(len(flat), np.int64)
    for j in range(1, SHINGLE_WORDS):
        more = left > j
        at = np.flatnonzero(more)
        run[at] = mix64(run[at] * _U(0x9E3779B97F4A7C15) + flat[at + j])
        joined[at] += 1
    keep = (joined == SHINGLE_WORDS) | first
    owner, run = owner[keep], run[keep]
    order = np.lexsort((run, owner))
    owner, run = owner[order], run[order]
    new = np.ones(len(run), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (run[1:] != run[:-1])
    at = np.flatnonzero(new)
    return owner[at], run[at], np.diff(np.r_[at, len(run)])


def darts(run: np.ndarray, weight: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The darts of weighted runs with rank under ``below``: index of the run,
    dart hash, rank."""
    found = []
    low, high = 0.0, 1.0
    while True:
        at = np.flatnonzero(weight > low)
        if not len(at):
            break
        layer = mix64(run[at] + _salt(int(high), 0xD6E8FEB86659FD93))
        rank, arrival = np.zeros(len(at)), 0
        while len(at):
            arrival += 1
            dart = mix64(layer + _salt(arrival, 0x9E3779B97F4A7C15))
            unit = ((dart >> _U(11)).astype(np.float64) + 0.5) / 2.0**53
            rank = rank - np.log(unit) / (high - low)
            live = rank < below[at]
            at, layer, rank, dart = at[live], layer[live], rank[live], dart[live]
            height = (mix64(dart ^ _U(0xA0761D6478BD642F)) >> _U(11)).astype(np.float64) / 2.0**53
            hit = low + height * (high - low) < weight[at]
            found.append((at[hit], dart[hit], rank[hit]))
        low, high = high, 2 * high
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def signatures(owner: np.ndarray, run: np.ndarray, weight: np.ndarray, texts: int, k: int) -> np.ndarray:
    """(texts, k) earliest dart per coordinate; rows of texts without runs are 0."""
    total = np.bincount(owner, weight, texts)
    out = np.zeros((texts, k), np.uint64)
    todo = total > 0
    reach = (k * math.log(k) + 2 * k) / np.maximum(total, 1)
    while todo.any():
        at = np.flatnonzero(todo[owner])
        index, dart, rank = darts(run[at], weight[at], reach[owner[at]])
        who = owner[at][index]
        cell = who * k + (mix64(dart ^ _U(0xE7037ED1A0B428DB)) % _U(k)).astype(np.int64)
        order = np.argsort(-rank, kind="stable")
        best = np.zeros(texts * k, np.uint64)
        filled = np.zeros(texts * k, bool)
        best[cell[order]] = dart[order]
        filled[cell] = True
        whole = filled.reshape(texts, k).all(1) & todo
        out[whole] = best.reshape(texts, k)[whole]
        todo &= ~whole
        reach = reach * 2
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    bands = signature.shape[1] // rows
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(rows):
        key = mix64(key * _U(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.astype(np.int64)


def _text_rows(batch: pa.RecordBatch, column: int):
    """Bounded runs of the batch's rows with their texts."""
    texts = batch.column(column)
    weights = [DART_WORDS + (n or 0) // 6 for n in pc.binary_length(texts).to_pylist()]
    for begin, end in slices(weights, BATCH_WORDS):
        yield begin, end, [t or "" for t in texts[begin:end].to_pylist()]


def signed(texts: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """tid, n_runs, band keys and sketch (a byte of every coordinate) of every text
    with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, own in _text_rows(batch, 1):
                owner, runs, weight = shingles(own)
                total = np.bincount(owner, weight, len(own)).astype(np.int64)
                signature = signatures(owner, runs, weight, len(own), bands * rows)
                keys = band_keys(signature, rows)
                full = total > 0
                sketch = (signature >> _U(8)).astype(np.uint8)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(full.sum() + 1) * bands, pa.int32()), pa.array(keys[full].ravel()))
                part = batch.slice(begin, end - begin).filter(pa.array(full))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(total[full]), lists, pa.array([x.tobytes() for x in sketch[full]], pa.binary())],
                    names=["tid", "n_runs", "bands", "sketch"])

    return short_batches(texts).select("tid", "text").mapInArrow(as_task("dartminhash", _forget, run), "tid binary, n_runs bigint, bands array<bigint>, sketch binary")


def similarity(left: list[str], right: list[str]) -> np.ndarray:
    """Exact weighted Jaccard index of pairs of texts."""
    n = len(left)
    owner, run, weight = (np.concatenate(x) for x in zip(shingles(left), shingles(right), strict=True))
    order = np.lexsort((run, owner))
    owner, run, weight = owner[order], run[order], weight[order]
    both = np.flatnonzero((owner[1:] == owner[:-1]) & (run[1:] == run[:-1]))
    total = np.bincount(owner, weight, n)
    shared = np.bincount(owner[both], np.minimum(weight[both], weight[both + 1]), n)
    return shared / np.maximum(total - shared, 1)


def _alike(x: np.ndarray, y: np.ndarray, share: float) -> np.ndarray:
    """Whether sketches (rows of bytes) agree in at least ``share`` of the
    coordinates."""
    return (x == y).mean(-1) >= share


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _verified(pairs: DataFrame, bodies: DataFrame, share: float) -> DataFrame:
    """a, b, distance of candidate pairs (tids) whose sketches agree in ``share``
    of the coordinates, from the whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                batch = batch.filter(pa.array(_alike(_sketches(batch.column(4)), _sketches(batch.column(5)), share)))
            sizes = [(x + y) // 6 for x, y in zip(pc.binary_length(batch.column(2)).to_pylist(),
                                                  pc.binary_length(batch.column(3)).to_pylist(), strict=True)]
            for begin, end in slices(sizes, BATCH_WORDS):
                part = batch.slice(begin, end - begin)
                d = 1 - similarity(part.column(2).to_pylist(), part.column(3).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(d)],
                                                 names=["a", "b", "distance"])

    own = bodies.select("tid", "text", "sketch")
    return (pairs.join(own.withColumnsRenamed({"tid": "a", "text": "left", "sketch": "ls"}), "a")
            .join(own.withColumnsRenamed({"tid": "b", "text": "right", "sketch": "rs"}), "b")
            .select("a", "b", "left", "right", "ls", "rs").mapInArrow(as_task("dartminhash", _forget, run), "a binary, b binary, distance double"))


def components(links: DataFrame) -> DataFrame:
    """v, root of every vertex of the links (a, b): alternating large and small
    stars until nothing changes; every round is a written table."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where(F.col("u") != F.col("v")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where(F.col("u") != F.col("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = written(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
                        .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "edges")
        found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    return edges.select(F.col("u").alias("v"), F.col("v").alias("root")).unionByName(
        edges.select("v", F.col("v").alias("root")).distinct())


def links(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, links, components): texts has a row per input row with its text id
    tid; links verified pairs of different texts; components v, root."""
    texts = docs.select(F.unhex(F.md5(F.col("text").cast("binary"))).alias("tid"),
                        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("did"), "text")
    table = written(signed(texts.where("text is not null"), bands, rows), "signatures")
    distinct = table.groupBy("tid").agg(*[F.first(c).alias(c) for c in ("n_runs", "bands")])
    keyed = written(distinct.select("tid", "n_runs", F.explode("bands").alias("key")), "bands")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = written(keyed.join(shared, "key"), "met")
    # a text that meets many others is likely to be what they were copied from
    degree = met.groupBy("tid").agg(F.sum("n").alias("degree"))
    met = written(met.drop("n").join(degree, "tid").select("key", "tid", "n_runs", "degree"), "met")
    # the texts that met another one are fetched once; always by a shuffle of tid
    needed = met.select("tid").distinct().hint("merge")
    some = texts.where("text is not null").join(needed, "tid", "left_semi").groupBy("tid").agg(F.first("text").alias("text"))
    sketch = table.select("tid", "sketch").join(needed, "tid", "left_semi").groupBy("tid").agg(F.first("sketch").alias("sketch"))
    bodies = written(some.join(sketch, "tid"), "bodies")

    close = 1 - threshold + 1e-12
    lead = met.groupBy("key").agg(F.max(F.struct("degree", "tid", "n_runs")).alias("l")).select(
        "key", F.col("l.tid").alias("a"), F.col("l.n_runs").alias("a_runs"))
    lead = written(lead, "leaders")
    near = F.least("n_runs", "a_runs") >= threshold * F.greatest("n_runs", "a_runs")
    stars = (met.join(lead, "key").where((F.col("tid") != F.col("a")) & near)
             .select("a", F.col("tid").alias("b")).distinct())
    known = written(_verified(stars, bodies, threshold - SLACK), "star-distances")
    first = known.where(F.col("distance") <= close).select("a", "b")
    groups = written(components(first), "star-components")

    # What the stars leave: texts outside the component of their bucket's leader
    # ("minor") look for any partner of another component in the bucket.
    roots = groups.select(F.col("v").alias("tid"), "root")
    lead_root = lead.join(roots.withColumnsRenamed({"tid": "a", "root": "r"}), "a", "left").select(
        "key", "a", "a_runs", F.coalesce("r", "a").alias("lead_root"))
    member = (met.join(roots, "tid", "left").join(lead_root, "key")
              .select("key", "tid", "n_runs", F.coalesce("root", "tid").alias("root"), "a", "a_runs", "lead_root")
              .withColumn("minor", F.col("root") != F.col("lead_root")))
    member = written(member, "members")
    mixed = written(member.join(member.where("minor").select("key").distinct(), "key", "left_semi"), "mixed-buckets")
    if mixed.isEmpty():
        return texts, first, groups
    alone = _unshared(bodies.join(mixed.select("tid").distinct(), "tid", "left_semi"))
    size_bound = 1 - F.least("n_runs", "a_runs") / F.greatest("n_runs", "a_runs")
    own = F.when(F.col("tid") == F.col("a"), 0.0).otherwise(F.col("distance"))
    bounds = (mixed.join(known.withColumnRenamed("b", "tid"), ["a", "tid"], "left").join(alone, "tid", "left")
              .select("key", "tid", "n_runs", "root", "minor", F.coalesce(own, size_bound).alias("low"),
                      F.coalesce(own, F.lit(1.0)).alias("high"), (F.col("n_runs") - F.coalesce("alone", F.lit(0))).alias("most")))
    # a text whose unshared runs alone take it below the threshold has no partner
    bounds = bounds.where(F.col("most") >= threshold * F.col("n_runs"))
    more = written(_across(bounds, bodies.join(distinct.select("tid", "bands"), "tid"), threshold), "rest-links")
    if more.isEmpty():
        return texts, first, groups
    found = first.unionByName(more)
    return texts, found, written(components(found), "components")


def _across(bounds: DataFrame, bodies: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between texts of different components in a bucket, one of
    them minor. Buckets are cut into blocks of about ``BLOCK`` texts and
    ``BLOCK_BYTES`` bytes; a row holds two blocks, so no pair becomes a row and
    every text is cut into runs once per row. A pair is looked at in the first
    bucket it shares, and its links are thinned to a spanning forest."""
    whole = bounds.join(bodies.select("tid", "text", "sketch", "bands"), "tid")
    size = bounds.join(bodies.select("tid", F.octet_length("text").alias("bytes")), "tid").groupBy("key").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"),
        F.max("minor").alias("any"))
    fields = ("tid", "n_runs", "root", "minor", "low", "high", "most", "text", "sketch", "bands")
    blocks = written(whole.join(size.where("any"), "key")
                     .withColumn("block", F.pmod(F.xxhash64("tid"), F.col("blocks")))
                     .groupBy("key", "block").agg(F.collect_list(F.struct(*fields)).alias("rows"), F.max("minor").alias("minor")),
                     "bucket-blocks")
    x, y = blocks.alias("x"), blocks.alias("y")
    both = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.block") <= F.col("y.block"))
                   & (F.col("x.minor") | F.col("y.minor")))
            .select("x.key", (F.col("x.block") == F.col("y.block")).alias("same"), F.col("x.rows").alias("p"), F.col("y.rows").alias("q")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                key, same, p, q = (batch.column(i)[row].as_py() for i in range(4))
                found = _block_links(key, p, None if same else q, threshold)
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.binary()) for i in (0, 1)], names=["a", "b"])

    return both.mapInArrow(as_task("dartminhash", _forget, run), "a binary, b binary").distinct()


def _block_links(key: int, p: list[dict], q: list[dict] | None, threshold: float) -> list[tuple[bytes, bytes]]:
    """The links between two blocks (or inside one) that join components."""
    rows = p if q is None else p + q

    def of(name: str, kind=None) -> np.ndarray:
        return np.array([r[name] for r in rows], kind)
    n, most, low, high, minor = of("n_runs"), of("most"), of("low"), of("high"), of("minor", bool)
    root = np.unique([r["root"] for r in rows], return_inverse=True)[1]
    sketch = np.frombuffer(b"".join(r["sketch"] for r in rows), np.uint8).reshape(len(rows), -1)
    band = of("bands")
    i, j = np.triu_indices(len(rows), 1) if q is None else (x.ravel() for x in np.meshgrid(
        np.arange(len(p)), np.arange(len(p), len(rows)), indexing="ij"))
    share = np.minimum(most[i], most[j])
    ok = ((minor[i] | minor[j]) & (root[i] != root[j]) & (share >= threshold * (n[i] + n[j] - share))
          & (np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]))
          & (np.maximum(low[i] - high[j], low[j] - high[i]) <= 1 - threshold + 1e-12))
    i, j = i[ok], j[ok]
    kept = []
    for begin in range(0, len(i), 20_000):
        a, b = i[begin:begin + 20_000], j[begin:begin + 20_000]
        good = _alike(sketch[a], sketch[b], threshold - SLACK)
        a, b = a[good], b[good]
        equal = band[a] == band[b]
        first = equal.argmax(1)
        here = band[a, first] == key
        kept.append((a[here], b[here]))
    if not kept or not sum(len(a) for a, _ in kept):
        return []
    i, j = (np.concatenate(x) for x in zip(*kept, strict=True))
    owner, run, weight = shingles([r["text"] for r in rows])
    at = np.searchsorted(owner, np.arange(len(rows) + 1))
    top = list(range(len(rows)))

    def head(v: int) -> int:
        while top[v] != v:
            top[v] = top[top[v]]
            v = top[v]
        return v

    out = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = head(a), head(b)
        if x == y:
            continue
        own, other = run[at[a]:at[a + 1]], run[at[b]:at[b + 1]]
        _, s, t = np.intersect1d(own, other, assume_unique=True, return_indices=True)
        shared = np.minimum(weight[at[a] + s], weight[at[b] + t]).sum()
        if shared >= (threshold - 1e-12) * (n[a] + n[b] - shared):
            top[y] = x
            out.append((rows[a]["tid"], rows[b]["tid"]))
    return out


def _unshared(bodies: DataFrame) -> DataFrame:
    """tid, alone: the weight of the runs that no other of these texts has. They
    are in no intersection, whatever the partner."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, own in _text_rows(batch, 1):
                owner, runs, weight = shingles(own)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(begin + owner)), pa.array(runs.astype(np.int64)), pa.array(weight)],
                    names=["tid", "run", "weight"])

    rows = bodies.select("tid", "text").mapInArrow(as_task("dartminhash", _forget, run), "tid binary, run bigint, weight bigint")
    once = rows.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.min("tid").alias("tid"), F.min("weight").alias("weight")).where("n = 1")
    return once.groupBy("tid").agg(F.sum("weight").alias("alone"))


def _text_classes(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """tid, root and class_id (smallest doc_id of the class) of every text."""
    doc_id = F.when(F.col("did") > NO_ID, F.col("did"))
    roots = groups.select(F.col("v").alias("tid"), "root")
    per_text = written(texts.where("tid is not null").groupBy("tid").agg(F.min(doc_id).alias("id"))
                       .join(roots, "tid", "left")
                       .select("tid", F.coalesce("root", "tid").alias("root"), "id"), "texts")
    best = per_text.groupBy("root").agg(F.min("id").alias("class_id"))
    return per_text.join(best, "root").select("tid", "root", "class_id")


def classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its class) and kept (the row carries
    that id), a row per row of ``docs``. A null text is a class of its own per
    doc_id."""
    texts, _, groups = links(docs, threshold, bands, rows)
    ids = texts.select("tid", F.when(F.col("did") > NO_ID, F.col("did")).alias("doc_id"))
    out = ids.join(_text_classes(texts.select("tid", "did"), groups), "tid", "left").select(
        "doc_id", F.when(F.col("tid").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)))


def representatives(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, one per class, all columns unchanged: the
    class's smallest doc_id (null last), then the smallest text id. Rows that
    repeat such an id and text are told apart by a row number. Null texts are
    copies of each other only under one doc_id."""
    texts, _, groups = links(docs, threshold, bands, rows)
    marked = texts.select("tid", "did").groupBy("tid", "did").agg(F.count(F.lit(1)).alias("n"))
    final = _text_classes(texts.select("tid", "did"), groups)
    no_id_last = F.when(F.col("did") == NO_ID, F.lit((1 << 63) - 1)).otherwise(F.col("did"))
    stay = (marked.where("tid is not null").join(final, "tid")
            .groupBy("root").agg(F.min(F.struct(no_id_last.alias("o"), "tid", "did", "n")).alias("m"))
            .select("m.tid", "m.did", "m.n"))
    stay = written(stay.unionByName(marked.where("tid is null")), "representatives")
    tid, did, t, d, n, row = (fresh(m, docs.columns) for m in ("__tid", "__did", "__t", "__d", "__n", "__row"))
    own = [F.col(quoted(c)) for c in docs.columns]
    key = docs.withColumns({tid: F.unhex(F.md5(F.col("text").cast("binary"))), did: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))})
    some = stay.select(F.col("tid").alias(t), F.col("did").alias(d), F.col("n").alias(n))
    kept = key.join(some, F.col(tid).eqNullSafe(F.col(t)) & (F.col(did) == F.col(d)))
    once = kept.where(F.col(n) == 1).select(*own)
    again = kept.where(F.col(n) > 1)
    # maps have no order: rows with one are ordered by their text
    least = F.min_by(F.struct(*own), F.to_json(F.struct(*own))) if "map<" in docs.schema.simpleString() else F.min(F.struct(*own))
    first = again.groupBy(tid, did).agg(least.alias(row))
    return once.unionByName(first.select(f"{row}.*"))
