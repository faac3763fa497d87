"""Benchmark decontamination on canonical templates.

A text becomes a sequence of canonical tokens in which numbers, names and units
are typed placeholders (``<num>``, ``<name>``, ``<unit>``) and everything else is
a lower-cased word. So "Anna buys 3 kg" and "Omar buys 40 km" share a template
and differ in their slots.

1. Every benchmark item is cut into its windows of ``WINDOW`` canonical tokens
   (an item with fewer tokens is one window). A window needs ``LITERALS`` plain
   words, else placeholders alone would match anything. An item with fewer in
   some run of ``WINDOW`` words (numbers, units, Title Case) is also cut into
   windows of its words as they are (lower-cased), whose matches are verbatim.
2. Documents emit a window only if its hash is set in a bitmap of the benchmark's
   windows. The bitmap has ``BITMAP_BITS`` bits whatever the benchmark's size (the
   only thing broadcast); a chance hit is dropped by the join.
3. Document windows and benchmark windows are hash-joined.
4. Slots are checked per copy: each benchmark slot value must stand for one
   document value throughout. Windows that disagree with the most frequent
   assignment do not count, so a re-parameterised copy passes and a chance
   sharing of templates does not. A document may hold several copies, each with
   values of its own, so the windows that may be one copy vote among themselves:
   those of one offset (position less item position), those of a stretch of
   offsets as long as the item (two grids, shifted by half of it: words put in
   or left out move the offset), and, for what is scattered, those of the whole
   document. The copy with the most windows decides. Windows with the item's own
   slot values count wherever they are.
5. A document leaks an item when at least ``ENOUGH`` of its windows agree (all of
   them, if it has fewer): thirteen words in a row, or the whole short item.
   Windows of words as they are count by themselves, by the same rule; they are
   reported when the templates show no leak.

Names are capitalised words inside a sentence; neighbouring names are one slot.
Units are words of a fixed list right after a number. In scripts without spaces
every character is a word.

Defined results: null and empty texts match nothing; items under ``LITERALS``
words match nothing; a document is a text under its id, so rows that share an id (or
have none) but not the text are looked at, and reported, one by one, and equal
rows are reported once; a null doc_id is reported as null; equal items are
reported under each item_id; extra columns are ignored; an empty table on either
side gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_task, mix64, short_batches, slices, written

WINDOW = 8
LITERALS = 4
ENOUGH = 6
BITMAP_BITS = 1 << 24
BATCH_WORDS, CACHE_WORDS = 300_000, 400_000

# fixed values: words that are units after a number
UNITS = frozenset("""mm cm m km inch inches ft feet foot yard yards mile miles mg g kg gram grams kilogram
kilograms lb lbs pound pounds oz ounce ounces ton tons ml l liter liters litre litres gallon gallons
second seconds sec minute minutes min hour hours h day days week weeks month months year years
dollar dollars usd euro euros eur cent cents percent degrees degree mph kmh watt watts volt volts""".split())

# fixed values: scripts that put no spaces between words (Thai, Lao, Myanmar, Khmer,
# Tai, Balinese, Javanese, kana, Han)
_UNSPACED = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u1b00-\u1b7f\ua980-\ua9ff\uaa60-\uaadf"
             "\u3005-\u3007\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff")
_TOKEN = re.compile(rf"\d+(?:[.,]\d+)*|[^\W\d_{_UNSPACED}]+|[{_UNSPACED}]|[.!?\n]")
_U = np.uint64
#: Kinds of canonical tokens; the codes of the slots go into the hashes.
WORD, NUM, NAME, UNIT, STOP = 0, 1, 2, 3, 4


class Tokens(dict):
    """Row numbers of raw tokens in ``columns``: value hash, hash as a plain word,
    kind inside a sentence, kind at its start, whether it is a unit word."""

    def __init__(self):
        super().__init__()
        self.columns = [array(kind) for kind in "QQbbb"]

    def __missing__(self, token: str) -> int:
        at = self[token] = len(self)
        for column, x in zip(self.columns, self._row(token)):
            column.append(x)
        return at

    @staticmethod
    def _row(token: str) -> tuple[int, int, int, int, int]:
        value = plain = xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass"))
        low = token.lower()
        if low != token:
            plain = xxhash.xxh3_64_intdigest(low.encode("utf-8", "surrogatepass"))
        if token in ".!?\n":
            return value, plain, STOP, STOP, 0
        if token[0].isdigit():
            return value, plain, NUM, NUM, 0
        named = len(token) > 1 and token[0].isupper() and token[1:].islower()
        return value, plain, NAME if named else WORD, WORD, int(low in UNITS)

    def forget(self) -> None:
        self.clear()
        for column in self.columns:
            del column[:]

    def rows(self, tokens: Iterator[str], n: int) -> tuple[np.ndarray, ...]:
        if len(self) > CACHE_WORDS:
            self.forget()
        at = np.fromiter(map(self.__getitem__, tokens), np.int64, n)
        return tuple(np.frombuffer(c, c.typecode)[at] if n else np.zeros(0, c.typecode) for c in self.columns)


_TOKENS = Tokens()


def _forget() -> None:
    _TOKENS.forget()


_PLACE = np.array([0, *(xxhash.xxh3_64_intdigest(x) for x in ("<num>", "<name>", "<unit>"))], np.uint64)


Cut = tuple[np.ndarray, tuple[np.ndarray, ...]]


def tokens(texts: list[str]) -> Cut:
    """owner and row of ``Tokens`` of the raw tokens of all texts."""
    found = [_TOKEN.findall(t) for t in texts]
    sizes = np.array([len(f) for f in found], np.int64)
    return np.repeat(np.arange(len(texts)), sizes), _TOKENS.rows(chain.from_iterable(found), int(sizes.sum()))


def canonical(cut: Cut) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """owner, canonical hash and slot value hash (0 for a plain word) of the
    canonical tokens of all texts."""
    owner, (value, plain, inside, at_start, unit) = cut
    n = len(owner)
    begins = np.ones(n, bool)
    begins[1:] = (owner[1:] != owner[:-1]) | (inside[:-1] == STOP)
    kind = np.where(begins, at_start, inside)
    kind[1:][(unit[1:] == 1) & (kind[:-1] == NUM) & (owner[1:] == owner[:-1])] = UNIT
    real = kind != STOP
    joined = np.zeros(n, bool)  # a name right after a name goes on with its slot
    joined[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME) & (owner[1:] == owner[:-1])
    head = np.flatnonzero(real & ~joined)
    slot = np.where(kind == WORD, _U(0), mix64(value))
    for at in np.flatnonzero(joined):
        slot[at] = mix64(slot[at - 1:at] * _U(31) + slot[at:at + 1])[0]
    last = np.flatnonzero(real & ~np.r_[joined[1:], False])
    return owner[head], np.where(kind[head] == WORD, plain[head], _PLACE[kind[head]]), slot[last]


def as_written(cut: Cut) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """owner, hash and 1 for what is no plain word (number, unit word, name) of
    the lower-cased words of all texts."""
    owner, (_, plain, inside, _, unit) = cut
    real = inside != STOP
    rest = (inside != WORD) | (unit == 1)
    return owner[real], plain[real], rest[real].astype(np.uint64)


def windows(read: tuple[np.ndarray, np.ndarray, np.ndarray], size: int, raw: bool = False) -> tuple[np.ndarray, ...]:
    """owner, hash, position, first token and number of plain words of the
    windows of ``size`` tokens of ``canonical`` or, ``raw``, ``as_written`` texts,
    and the slot values of all tokens. A template's window needs ``LITERALS`` plain words."""
    owner, canon, slot = read
    n = max(0, len(owner) - size + 1)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none, none, slot
    key = np.full(n, size + (WINDOW + 1) * raw, np.uint64)
    for j in range(size):
        key = mix64(key * _U(0x9E3779B97F4A7C15) + canon[j:j + n])
    below = np.r_[0, np.cumsum(slot == 0)]
    plain = below[size:] - below[:-size]
    at = np.flatnonzero((owner[:n] == owner[size - 1:size - 1 + n]) & (raw | (plain >= min(LITERALS, size))))
    first = np.r_[0, np.flatnonzero(owner[1:] != owner[:-1]) + 1]
    begin = np.zeros(int(owner.max()) + 1, np.int64)
    begin[owner[first]] = first
    return owner[at], key[at], at - begin[owner[at]], at, plain[at], slot


def _slots(slot: np.ndarray, at: np.ndarray, size: int) -> pa.Array:
    """The slot values of the windows that begin at ``at``."""
    values = slot[at[:, None] + np.arange(size)].astype(np.int64).ravel()
    return pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * size, pa.int32()), pa.array(values))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, n (windows of the item), span (its tokens), size, raw, pos, key,
    slots. An item shorter than ``WINDOW`` has one window of its own length. Raw
    windows (of words as they are, without slots) are of items of which some have
    less than ``LITERALS`` plain words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for raw, reader in ((False, canonical), (True, as_written)):
                count = np.bincount(reader(tokens(texts))[0], minlength=len(texts))
                for size in range(LITERALS, WINDOW + 1):
                    at = np.flatnonzero(count >= WINDOW if size == WINDOW else count == size)
                    if not len(at):
                        continue
                    owner, key, pos, first, plain, slot = windows(reader(tokens([texts[i] for i in at])), size, raw)
                    if raw:
                        own = np.isin(owner, owner[plain < LITERALS])
                        owner, key, pos, first = owner[own], key[own], pos[own], first[own]
                    total = np.bincount(owner, minlength=len(at))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at[owner])), pa.array(total[owner]), pa.array(count[at][owner]),
                         pa.array(np.full(len(owner), size, np.int32)), pa.array(np.full(len(owner), raw)), pa.array(pos),
                         pa.array(key.astype(np.int64)), _slots(slot, first, 0 if raw else size)],
                        names=["item_id", "n", "span", "size", "raw", "pos", "key", "slots"])

    return benchmark.select(F.col("item_id").cast("bigint"), "text").mapInArrow(
        as_task("decontaminate", _forget, run), "item_id bigint, n bigint, span bigint, size int, raw boolean, pos bigint, key bigint, slots array<bigint>")


def window_bitmap(items: DataFrame) -> tuple[np.ndarray, list[tuple[bool, int]]]:
    """The bitmap of the benchmark's window hashes and the kinds of windows (raw,
    size) in use.
    At most ``BITMAP_BITS / 64`` rows reach the driver, whatever the benchmark."""
    bit = F.pmod("key", F.lit(BITMAP_BITS))
    cells = items.groupBy(F.shiftright(bit, 6).alias("cell")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(key, {BITMAP_BITS}) & 63 as int))")).alias("bits"),
        F.collect_set(F.struct("raw", "size")).alias("sizes"))
    bitmap, sizes = np.zeros(BITMAP_BITS // 64, np.int64), set()
    for r in cells.toLocalIterator():
        bitmap[r.cell] = r.bits
        sizes.update((s.raw, s.size) for s in r.sizes)
    return bitmap.view(np.uint64), sorted(sizes)


def document_windows(docs: DataFrame, bitmap: np.ndarray, sizes: list[tuple[bool, int]]) -> DataFrame:
    """doc_id, tid, size, raw, pos, key, slots of the documents' windows that may match."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            texts = batch.column(1)
            weights = [(x or 0) // 6 for x in pc.binary_length(texts).to_pylist()]
            for begin, end in slices(weights, BATCH_WORDS):
                own = [t or "" for t in texts[begin:end].to_pylist()]
                cut = tokens(own)
                read = {raw: as_written(cut) if raw else canonical(cut) for raw in {raw for raw, _ in sizes}}
                for raw, size in sizes:
                    owner, key, pos, first, _, slot = windows(read[raw], size, raw)
                    bit = key % _U(BITMAP_BITS)
                    hit = np.flatnonzero(bits[(bit >> _U(6)).astype(np.int64)] >> (bit & _U(63)) & _U(1))
                    at = pa.array(begin + owner[hit])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at), batch.column(2).take(at), pa.array(np.full(len(hit), size, np.int32)),
                         pa.array(np.full(len(hit), raw)), pa.array(pos[hit]), pa.array(key[hit].astype(np.int64)),
                         _slots(slot, first[hit], 0 if raw else size)],
                        names=["doc_id", "tid", "size", "raw", "pos", "key", "slots"])

    return short_batches(docs).select(F.col("doc_id").cast("bigint"), "text", text_id(F.col("text")).alias("tid")).mapInArrow(
        as_task("decontaminate", _forget, run), "doc_id bigint, tid binary, size int, raw boolean, pos bigint, key bigint, slots array<bigint>")


def text_id(text: Column) -> Column:
    """What tells texts apart; null for a null text."""
    return F.unhex(F.md5(text.cast("binary")))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows of the item, matched (windows that agree),
    verbatim (of these, with the item's own slot values) for every leak."""
    return text_leaks(docs, benchmark).drop("tid")


def text_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``leaks`` with tid, the ``text_id`` of the leaking text."""
    items = written(item_windows(benchmark), "benchmark-windows")
    bitmap, sizes = window_bitmap(items)
    found = document_windows(docs, bitmap, sizes)
    pair = ["doc_id", "tid", "item_id", "raw", "n"]
    hits = written(found.join(items.withColumnsRenamed({"slots": "item_slots", "pos": "item_pos"}), ["key", "size", "raw"])
                   .select(*pair, "span", "item_pos", "item_slots", "slots", (F.col("pos") - F.col("item_pos")).alias("off")), "template-hits")
    own = F.col("item_slots") == F.col("slots")
    counted = (hits.select(*pair, "item_pos", own.alias("own"), F.lit(None).cast("struct<kind:int,at:bigint>").alias("copy"))
               .where("own").unionByName(_agreeing(hits, pair).select(*pair, "item_pos", F.lit(False).alias("own"), "copy")))
    # own windows count in every copy; the others once in theirs
    places = counted.groupBy(*pair, "item_pos").agg(F.max("own").alias("own"), F.collect_set("copy").alias("copies"))
    copies = (places.select(*pair, "own", F.explode(F.when(F.col("own"), F.array(F.lit(None).cast("struct<kind:int,at:bigint>")))
                                                    .otherwise(F.col("copies"))).alias("copy"))
              .groupBy(*pair, "copy").agg(F.count(F.lit(1)).alias("w")))
    verbatim = F.coalesce(F.max(F.when(F.col("copy").isNull(), F.col("w"))), F.lit(0))
    best = F.coalesce(F.max(F.when(F.col("copy").isNotNull(), F.col("w"))), F.lit(0))
    leaked = (copies.groupBy(*pair).agg((verbatim + best).alias("matched"), verbatim.alias("verbatim"))
              .where(F.col("matched") >= F.least(F.lit(ENOUGH), F.col("n"))))
    row = F.struct("raw", F.col("n").alias("n_windows"), "matched", "verbatim")  # templates first
    return (leaked.groupBy("doc_id", "tid", "item_id").agg(F.min(row).alias("m"))
            .select("doc_id", "tid", "item_id", "m.n_windows", "m.matched", "m.verbatim"))


def _agreeing(hits: DataFrame, pair: list[str]) -> DataFrame:
    """pair, item_pos and copy of the windows with other slot values than the
    item's that agree with the most frequent values of their copy."""
    off, span = F.col("off"), F.col("span")
    kinds = (F.lit(0).cast("bigint"), off, F.floor(off / span), F.floor((off + F.floor(span / 2)) / span))
    copy = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), at.cast("bigint").alias("at")) for k, at in enumerate(kinds)]))
    # a pair without such a window has nothing to vote on
    other = hits.where("slots != item_slots").select(*pair).distinct().withColumnsRenamed({c: f"o_{c}" for c in pair})
    voting = hits.where("exists(item_slots, v -> v != 0)")
    voting = voting.join(other, _same(pair, "o_"), "left_semi")
    # equal windows of a copy are one row per item position and slot values
    voting = (voting.select(*pair, "item_pos", "item_slots", "slots", copy.alias("copy"))
              .groupBy(*pair, "copy", "item_pos", "item_slots", "slots").agg(F.count(F.lit(1)).alias("times")))
    values = (voting.select(*pair, "copy", F.explode(F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"))).alias("p"))
              .where("p.i != 0").groupBy(*pair, "copy", F.col("p.i").alias("i"), F.col("p.d").alias("d")).agg(F.count(F.lit(1)).alias("w")))
    most = F.max(F.struct("w", (F.col("i") == F.col("d")).alias("own"), F.bitwise_not("d").alias("last"), "d"))
    chosen = (values.groupBy(*pair, "copy", "i").agg(most.alias("m"))
              .groupBy(*pair, "copy").agg(F.map_from_entries(F.collect_list(F.struct("i", "m.d"))).alias("as"))
              .withColumnsRenamed({c: f"c_{c}" for c in [*pair, "copy"]}))
    agree = F.expr("forall(arrays_zip(item_slots, slots), p -> p.item_slots = 0 OR as[p.item_slots] = p.slots)")
    return (voting.where("slots != item_slots").join(chosen, _same(pair, "c_") & (F.col("copy") == F.col("c_copy")))
            .where(agree).select(*pair, "item_pos", "copy"))


def _same(columns: list[str], prefix: str) -> Column:
    """The columns equal, nulls too, those of the other side with the prefix."""
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in columns])
