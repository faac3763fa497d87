"""Language identification by a linear-chain conditional random field over words.

Each word of a text is a position of the chain. Its emission scores are sums of
weights of hashed features: prefixes and suffixes (affixes), character n-grams
within word marks, and membership in learned lexicons. Transition weights are
learned along with them, so the chain can switch language within a text.
Forward-backward gives every word a distribution over the languages; a text's
language is the one with the largest mean share over its words, and that share
is the score.

Training. The classifier is fitted on a bounded sample of labelled rows:
``TRAIN_DOCS`` rows per language (those with the smallest hash of doc_id and
text) among the rows that have words, for the ``LANGUAGES`` languages most frequent
there; equal rows count once. A row longer than ``TRAIN_CHARS`` characters (or its
share of ``TRAIN_TOTAL``, if less) gives ``PIECES`` pieces of that length together,
from its first word on and evenly over the text. The bounds are parameters. The rows are cut into short runs that are
shuffled into code-switched training chains, so transitions between
languages are seen. Prediction reads every word of every text.

Prediction. A chain is cut into blocks; each block's transfer matrix (product
of transition and emission steps) is computed for all blocks of a batch at
once, the blocks are linked by one forward and one backward pass over their
matrices, and the positions inside follow. The result equals the word-by-word
recursion.

Defined results: null text and text without a letter give ``und`` with score 0;
if no labelled row exists every text gives ``und``; ties go to the language
that sorts first; equal texts give equal rows; an empty table gives an empty
result; extra columns pass through untouched where the operator keeps rows.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import arrow_mapped, give_back, quoted, short_batches, slices, take_over

TRAIN_DOCS = 200
TRAIN_CHARS = 20_000
#: Characters of all training rows: with many languages each row gives fewer.
TRAIN_TOTAL = 16_000_000
#: The rows of a language are chosen in so many parts first.
SALTS = 16
#: Pieces drawn from a longer row.
PIECES = 20
LANGUAGES = 200
#: Hashed feature weights per language.
FEATURES = 1 << 16
#: Words of a training run, and of a training chain.
RUN_WORDS, CHAIN_WORDS = 24, 96
EPOCHS, RATE, DECAY = 30, 0.25, 1e-6
#: Words times languages of the chains that are trained at once.
TRAIN_CELLS = 2_000_000
#: A word enters a language's lexicon when seen this often and mostly there.
LEXICON_SEEN, LEXICON_SHARE = 3, 0.8
#: Words handled at once, words of a block, scored words remembered.
BATCH_WORDS, BLOCK, CACHE_WORDS = 200_000, 32, 400_000
#: New words whose features are looked up at once (about 1 KB each meanwhile).
NEW_WORDS = 16_384
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")
#: Characters of words, for Spark's expressions.
_LETTER = "\\p{L}\\p{Nl}\\p{No}"


def words(text: str | None) -> list[str]:
    """The words of a text; a run of numerals ("½", "ⅷ") without a letter is none."""
    found = _WORD.findall(text.lower()) if text else []
    return found if not text or text.isascii() else [w for w in found if w.isalpha() or any(map(str.isalpha, w))]


def features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Feature slots of a word; the slots after ``FEATURES`` are lexicons."""
    marked = f"<{word}>"
    named = [f"p{word[:n]}" for n in (1, 2, 3) if n <= len(word)]
    named += [f"s{word[-n:]}" for n in (1, 2, 3) if n <= len(word)]
    named += [f"2{marked[i:i + 2]}" for i in range(len(marked) - 1)]
    named += [f"3{marked[i:i + 3]}" for i in range(len(marked) - 2)]
    slots = [zlib.crc32(x.encode("utf-8", "surrogatepass")) % FEATURES for x in named]
    if word in lexicon:
        slots.append(FEATURES + lexicon[word])
    return slots


@dataclass
class Model:
    """What is broadcast: at most LANGUAGES x FEATURES weights and lexicons of
    the bounded sample."""

    languages: list[str]
    weights: np.ndarray      # (FEATURES + languages, languages)
    transition: np.ndarray   # (languages, languages), log scale
    lexicon: dict[str, int]


def _forward_backward(psi: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Posteriors, expected transitions and log-likelihood normaliser of equal
    chains: psi (chains, positions, languages), step the transition factors."""
    chains, n, k = psi.shape
    fore, scale = np.empty_like(psi), np.empty((chains, n))
    now = np.full((chains, k), 1.0 / k)
    for t in range(n):
        now = (now @ step) * psi[:, t]
        scale[:, t] = now.sum(1)
        now = now / scale[:, t, None]
        fore[:, t] = now
    back, pairs = np.ones((chains, k)), np.zeros((k, k))
    post = np.empty_like(psi)
    for t in range(n - 1, -1, -1):
        post[:, t] = fore[:, t] * back
        ahead = psi[:, t] * back / scale[:, t, None]
        before = fore[:, t - 1] if t else np.full((chains, k), 1.0 / k)
        pairs += step * (before.T @ ahead)
        back = ahead @ step.T
    return post / post.sum(2, keepdims=True), pairs, float(np.log(scale).sum())


def train(rows: list[tuple[str, str, int]]) -> Model | None:
    """Fits the field on (language, text, shuffle hash) rows by full-batch
    gradient steps (Adam) on the chains' conditional log-likelihood."""
    languages = sorted({lang for lang, _, _ in rows})
    at = {lang: i for i, lang in enumerate(languages)}
    runs, seen = [], Counter()
    for lang, text, h in rows:
        found = words(text)
        seen.update((w, at[lang]) for w in found)
        for n, i in enumerate(range(0, len(found), RUN_WORDS)):
            runs.append((zlib.crc32(f"{h}:{n}".encode()), at[lang], found[i:i + RUN_WORDS]))
    runs.sort(key=lambda r: (r[0], r[1], r[2]))
    if not runs:
        return None
    total: Counter = Counter()
    for (w, _), n in seen.items():
        total[w] += n
    lexicon = {w: i for (w, i), n in sorted(seen.items())
               if n >= LEXICON_SEEN and n >= LEXICON_SHARE * total[w]}
    vocabulary: dict[str, int] = {}
    word_ids = [vocabulary.setdefault(w, len(vocabulary)) for _, _, found in runs for w in found]
    labels = [lang for _, lang, found in runs for _ in found]
    chains = max(1, len(word_ids) // CHAIN_WORDS)
    length = min(CHAIN_WORDS, len(word_ids))
    x = np.array(word_ids[:chains * length]).reshape(chains, length)
    y = np.array(labels[:chains * length]).reshape(chains, length)
    k, slots, sizes = len(languages), array("i"), array("i")
    for w in vocabulary:
        own = features(w, lexicon)
        slots.extend(own)
        sizes.append(len(own))
    flat, sizes = np.array(slots), np.array(sizes)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    del runs, seen, total, slots
    weights, trans = np.zeros((FEATURES + k, k)), np.zeros((k, k))
    true = np.zeros((len(vocabulary), k))
    np.add.at(true, (x.ravel(), y.ravel()), 1.0)
    true_pairs = np.zeros((k, k))
    np.add.at(true_pairs, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1.0)
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(trans), np.zeros_like(trans)]
    for epoch in range(1, EPOCHS + 1):
        emission = np.stack([np.add.reduceat(weights[flat, i], starts) for i in range(k)], 1)  # a language at a time
        factors = np.exp(emission - emission.max(1, keepdims=True))
        expected, pairs = np.zeros_like(true), np.zeros((k, k))
        for own in np.array_split(x, -(-x.size * k // TRAIN_CELLS)):
            post, found, _ = _forward_backward(factors[own], np.exp(trans - trans.max()))
            pairs += found
            for i in range(k):
                expected[:, i] += np.bincount(own.ravel(), post[..., i].ravel(), len(vocabulary))
        residual = (true - expected) / x.size
        slope = np.stack([np.bincount(flat, residual[owner, i], len(weights)) for i in range(k)], 1)
        first = np.zeros((k, k))  # the virtual start is uniform over languages
        np.add.at(first, (slice(None), y[:, 0]), 1.0 / k)
        for value, grad, m, v in ((weights, slope - DECAY * weights, *moments[:2]),
                                  (trans, (true_pairs + first - pairs) / x.size, *moments[2:])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value += RATE * (m / (1 - 0.9 ** epoch)) / (np.sqrt(v / (1 - 0.99 ** epoch)) + 1e-8)
    return Model(languages, weights.astype(np.float32), trans, lexicon)


def fit(docs: DataFrame, labelled: Column, train_docs: int = TRAIN_DOCS) -> Model | None:
    """The field learned from ``docs`` rows that satisfy ``labelled`` (a Column
    over doc_id) and carry a language.

    Narrow rows choose the sample - a row_number per language, limited before
    its shuffle - and only the chosen rows' texts are fetched (bounded by
    ``TRAIN_TOTAL`` characters, or 400 a row if that is more)."""
    pick = F.xxhash64(F.col("doc_id").cast("string"), "text", F.lit(17))
    # the pattern decodes what it reads: most texts show a word at their start
    spoken = F.substring("text", 1, 200).rlike("\\p{L}") | F.col("text").rlike("\\p{L}")
    pool = docs.where(labelled & F.col("lang").isNotNull() & spoken).select("doc_id", "lang", "text", pick.alias("pick"))
    narrow = pool.select("doc_id", "lang", "pick")
    langs = [r[0] for r in narrow.groupBy("lang").count()
             .orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()]
    chosen = narrow.where(F.col("lang").isin(langs)).distinct().withColumn("salt", F.pmod("pick", F.lit(SALTS)))
    for group in (["lang", "salt"], ["lang"]):  # a frequent language meets in one task as SALTS * train_docs rows
        order = Window.partitionBy(*group).orderBy("pick", "doc_id")
        chosen = chosen.withColumn("n", F.row_number().over(order)).where(F.col("n") <= train_docs)
    chosen = chosen.select("doc_id", "lang", "pick")
    chars = max(20 * PIECES, min(TRAIN_CHARS, TRAIN_TOTAL // max(1, len(langs) * train_docs)))
    rows = pool.join(F.broadcast(chosen), ["doc_id", "lang", "pick"])
    # equal rows are one
    keep = rows.select("doc_id", "lang", sample(F.col("text"), chars).alias("text"), "pick").distinct()
    return train(sorted((r.lang, r.text, r.pick) for r in keep.collect()))


def sample(text: Column, chars: int = TRAIN_CHARS) -> Column:
    """A text of up to ``chars`` characters as it is; else its pieces, less
    words that the cuts split, unless such a word is all there is."""
    size, last = chars // PIECES, PIECES - 1

    def piece(body: Column, k: Column) -> Column:
        begin = F.floor((F.length(body) - size).cast("bigint") * k / F.lit(last)).cast("int")
        own = F.substr(body, begin + 1, F.lit(size))
        left = F.when(k == 0, own).otherwise(F.regexp_replace(own, f"^[{_LETTER}]++", ""))
        whole = F.when(k == last, left).otherwise(F.regexp_replace(left, f"[{_LETTER}]++$", ""))
        return F.when(whole.rlike(f"[{_LETTER}]"), whole).otherwise(own)

    def cut(body: Column) -> Column:
        pieces = F.transform(F.sequence(F.lit(0), F.lit(last)), lambda k: piece(body, k))
        return F.when(F.length(body) <= chars, body).otherwise(F.array_join(pieces, "\n"))  # what follows the first word may be short

    # one expression for all pieces, evaluated over a body that is cut once
    body = F.regexp_replace(text, f"^[^{_LETTER}]++", "")
    return F.when(F.length(text) <= chars, text).otherwise(F.transform(F.array(body), cut)[0])


class Scorer:
    """Emission factors per word, computed once per distinct word."""

    def __init__(self, model: Model):
        self.model, self.ids, self.rows = model, {}, []

    def factors(self, found: list[str]) -> np.ndarray:
        if len(self.ids) > CACHE_WORDS:
            self.ids.clear()
            self.rows.clear()
            self.table = None
        new = [w for w in dict.fromkeys(found) if w not in self.ids]
        for at in range(0, len(new), NEW_WORDS):
            part = new[at:at + NEW_WORDS]
            slots = [features(w, self.model.lexicon) for w in part]
            sums = np.add.reduceat(self.model.weights[np.array([s for own in slots for s in own])],
                                   np.r_[0, np.cumsum([len(own) for own in slots])[:-1]])
            start = len(self.ids)
            self.ids.update(zip(part, range(start, start + len(part)), strict=True))
            self.rows.append(np.maximum(np.exp(sums - sums.max(1, keepdims=True)), 1e-30))
            self.rows = [np.concatenate(self.rows)] if len(self.rows) > 64 else self.rows
            self.table = None
        if getattr(self, "table", None) is None:
            self.rows = [np.concatenate(self.rows)]
            self.table = self.rows[0]
        return self.table[np.fromiter(map(self.ids.__getitem__, found), np.int64, len(found))]


def posteriors(psi: np.ndarray, sizes: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Word posteriors of chains laid end to end: psi (words, languages), sizes
    the words of each chain (all positive), step the transition factors."""
    k = psi.shape[1]
    blocks = -(-sizes // BLOCK)
    first_block = np.r_[0, np.cumsum(blocks)[:-1]]
    first_word = np.r_[0, np.cumsum(sizes)[:-1]]
    chain = np.repeat(np.arange(len(sizes)), sizes)
    offset = np.arange(len(psi)) - first_word[chain]
    cell = first_block[chain] * BLOCK + offset
    total = int(blocks.sum())
    grid, used = np.ones((total * BLOCK, k)), np.zeros(total * BLOCK, bool)
    grid[cell], used[cell] = psi, True
    grid, used = grid.reshape(total, BLOCK, k), used.reshape(total, BLOCK)
    product = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for t in range(BLOCK):
        on = used[:, t]
        moved = (product[on] @ step) * grid[on, t][:, None, :]
        product[on] = moved / moved.max((1, 2), keepdims=True)
    by_length = np.argsort(-blocks, kind="stable")
    ordered = blocks[by_length]
    enter, leave = np.empty((total, k)), np.empty((total, k))
    now = np.full((len(sizes), k), 1.0 / k)
    for b in range(int(ordered[0])):
        live = by_length[:int(np.searchsorted(-ordered, -b, "left"))]
        at = first_block[live] + b
        enter[at] = now[live]
        moved = np.einsum("bi,bij->bj", now[live], product[at])
        now[live] = moved / moved.sum(1, keepdims=True)
    now = np.ones((len(sizes), k))
    for b in range(int(ordered[0]) - 1, -1, -1):
        live = by_length[:int(np.searchsorted(-ordered, -b, "left"))]
        at = first_block[live] + b
        leave[at] = now[live]
        moved = np.einsum("bij,bj->bi", product[at], now[live])
        now[live] = moved / moved.sum(1, keepdims=True)
    post = np.empty_like(grid)
    for t in range(BLOCK):
        moved = (enter @ step) * grid[:, t]
        enter = np.where(used[:, t, None], moved / moved.sum(1, keepdims=True), enter)
        post[:, t] = enter
    for t in range(BLOCK - 1, -1, -1):
        post[:, t] *= leave
        moved = (grid[:, t] * leave) @ step.T
        leave = np.where(used[:, t, None], moved / moved.sum(1, keepdims=True), leave)
    out = post.reshape(-1, k)[cell]
    return out / out.sum(1, keepdims=True)


def _predict(model: Model, scorer: Scorer, texts: list[list[str]]) -> list[tuple[str, float, float]]:
    """Language, its mean share and the mean of each word's largest share."""
    out: list[tuple[str, float, float]] = [(UNKNOWN, 0.0, 0.0)] * len(texts)
    full = [i for i, found in enumerate(texts) if found]
    if not full:
        return out
    sizes = np.array([len(texts[i]) for i in full])
    psi = scorer.factors([w for i in full for w in texts[i]])
    trans = model.transition
    post = posteriors(psi.astype(np.float64), sizes, np.exp(trans - trans.max()))
    begin = np.r_[0, np.cumsum(sizes)[:-1]]
    share = np.add.reduceat(post, begin) / sizes[:, None]
    sure = np.add.reduceat(post.max(1), begin) / sizes
    for i, row, own in zip(full, share, sure, strict=True):
        best = int(row.argmax())
        out[i] = model.languages[best], float(min(1.0, row[best])), float(min(1.0, own))
    return out


_SCORERS: dict[int, tuple[Model, Scorer]] = {}


def predict(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",),
            marks: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns and the language, its share and, if a third name is
    given, the words' mean certainty (share of each word's own best language),
    named ``marks``. Only text is looked at."""
    schema = StructType([*(docs.schema[c] for c in keep), StructField(marks[0], StringType()), *(StructField(m, DoubleType()) for m in marks[1:])])
    if model is None:
        return docs.select(*map(quoted, keep), F.lit(UNKNOWN).alias(marks[0]), *(F.lit(0.0).alias(m) for m in marks[1:]))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    sent = keep if "text" in keep else (*keep, "text")  # a kept text travels once
    at = sent.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        take_over("crf_langid", _SCORERS.clear)
        if id(own) not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[id(own)] = own, Scorer(own)
        scorer = _SCORERS[id(own)][1]
        for batch in batches:
            texts = batch.column(at)
            weights = [(n or 0) // 6 for n in pc.binary_length(texts).to_pylist()]
            found: list[tuple[str, float, float]] = []
            for begin, end in slices(weights, BATCH_WORDS):
                found += _predict(own, scorer, [words(t) for t in texts[begin:end].to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array([x[0] for x in found], pa.string()),
                 *(pa.array([x[n] for x in found], pa.float64()) for n in range(1, len(marks)))],
                names=[*keep, *marks])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return arrow_mapped(short_batches(docs).select(*map(quoted, sent)), task, schema)


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id's text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def trained_rows(doc_id: Column) -> Column:
    return doc_id.isNotNull() & ~held_out(doc_id)


