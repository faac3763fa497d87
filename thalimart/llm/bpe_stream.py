"""Byte-level BPE as a streaming transducer with bounded lookahead.

Text goes in piece by piece, token ids come out as soon as no later byte can
change them, and the state kept in between has a size fixed by the merge list.

Lookahead. Merging is left to right at equal rank and by rank otherwise, so
what lies right of a boundary reaches the left only by merging *across* that
boundary. A rule B = (x, y) merges across it only if a token y stands right of
it when B's rank comes; whether y stands there depends on y's own bytes and on
the boundary after y, across which only a rule of lower rank whose left operand
lies on the right edge of y's merge tree can reach. So B reads at most

    reach(B) = |y| + max(0, reach(B') : rank B' < rank B, B'.left on y's right edge)

bytes, and ``lookahead`` = max reach(B). A boundary with that many bytes after
it is final: the text left of it is encoded for good, and the rest goes on as
if it began there. The recurrence needs a list in which each rule's operands
are made by earlier rules; any other list is refused.

Decoding is a state machine from token bytes to text that holds back at most
the three bytes of an unfinished UTF-8 sequence.

Defined results: null text is the empty text (no ids); empty text gives no
ids; a text of any length is streamed whole; equal rows give equal rows; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import as_task, short_batches, take_over

#: Characters given to an encoder at a time.
PIECE = 1 << 16
#: A pretoken longer than this is streamed into the merge transducer.
LONG_RUN = 2048
#: Pretokens remembered per process (a cache of finished work only).
CACHE_ENTRIES = 400_000

# fixed values: the pretoken pattern of byte-level BPE
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_LATIN_END = 0x250


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def latin_classes() -> tuple[str, str]:
    """Letters and numbers below U+0250 as members of a character class."""
    kinds: dict[str, list[str]] = {"L": [], "N": []}
    for i in range(_LATIN_END):
        kinds.setdefault(unicodedata.category(chr(i))[0], []).append(re.escape(chr(i)))
    return "".join(kinds["L"]), "".join(kinds["N"])


def _latin_pattern() -> re.Pattern:
    """``PRETOKEN`` for text below U+0250, for the faster built-in engine. The
    alternatives begin with different characters, so letters can come first."""
    letter, number = latin_classes()
    return re.compile(rf" ?[{letter}]+| ?[{number}]+|'(?:s|t|re|ve|m|ll|d)"
                      rf"| ?[^\s{letter}{number}\x1c-\x1f]+|\s+(?!\S)|\s+")


_PRETOKENS = regex.compile(PRETOKEN)
_LATIN = _latin_pattern()
#: Beyond Latin, or control characters that the two engines class differently.
_NOT_LATIN = re.compile("[^\x00-\x1b\x20-ɏ]")
_RUNS = {"letter": regex.compile(r"\p{L}*"), "number": regex.compile(r"\p{N}*"),
         "space": regex.compile(r"\s*"), "other": regex.compile(r"[^\s\p{L}\p{N}]*")}


def pretokens(text: str) -> list[str]:
    return (_PRETOKENS if _NOT_LATIN.search(text) else _LATIN).findall(text)


class MergeList:
    """Vocabulary, merge ranks and the lookahead computed from them."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        vocab: dict[str, int] = model["vocab"]
        symbols = byte_symbols()
        back = {s: b for b, s in enumerate(symbols)}
        self.byte_ids = [vocab[s] for s in symbols]
        size = max([*vocab.values(), *(t["id"] for t in data["added_tokens"])]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(back[c] for c in token)
        self.specials = {t["content"]: t["id"] for t in data["added_tokens"] if t["special"]}
        for token, i in self.specials.items():
            self.token_bytes[i] = token.encode()
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        parts: list[tuple[int, int]] = []
        for r, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = vocab[left], vocab[right]
            self.rank[a << 20 | b] = r
            self.made.append(vocab[left + right])
            parts.append((a, b))
        self.lookahead = self._lookahead(parts)

    def _lookahead(self, parts: list[tuple[int, int]]) -> int:
        edge: dict[int, set[int]] = {i: {i} for i in self.byte_ids}
        reach_from: dict[int, int] = {}
        most = 0
        for (a, b), new in zip(parts, self.made, strict=True):
            if a not in edge or b not in edge:
                raise ValueError("a merge uses a token that no earlier merge makes")
            reach = len(self.token_bytes[b]) + max((reach_from.get(x, 0) for x in edge[b]), default=0)
            reach_from[a] = max(reach_from.get(a, 0), reach)
            edge.setdefault(new, {new}).update(edge[b])
            most = max(most, reach)
        return most

    def merge(self, data: bytes) -> list[int]:
        """Ids of one short piece: the lowest rank first, leftmost at equal rank."""
        ids = [self.byte_ids[b] for b in data]
        if len(ids) > 48:
            return self._merge_long(ids)
        rank, none = self.rank.get, len(self.made)
        ranks = [rank(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == none:
                break
            at = ranks.index(low)
            ids[at:at + 2] = [self.made[low]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(ids[at - 1] << 20 | ids[at], none)
            if at < len(ranks):
                ranks[at] = rank(ids[at] << 20 | ids[at + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list."""
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i) for i in range(n - 1) if (r := self.rank.get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or self.rank.get(ids[i] << 20 | ids[j]) != r:
                continue
            ids[i], alive[j], after[i] = self.made[r], False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (x := self.rank.get(ids[left] << 20 | ids[right])) is not None:
                    heapq.heappush(heap, (x, left))
        return [ids[i] for i in range(n) if alive[i]]


class RunTransducer:
    """One pretoken of any length, byte by byte, in memory that depends only on
    the merge list: a token leaves once ``lookahead`` bytes follow it."""

    def __init__(self, merges: MergeList):
        self.merges, self.buffer = merges, b""
        self.block = 4 * merges.lookahead + 1024

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        for at in range(0, len(data), self.block):
            self.buffer += data[at:at + self.block]
            if len(self.buffer) >= self.block:
                out += self._emit(len(self.buffer) - self.merges.lookahead)
        return out

    def _emit(self, stable: int) -> list[int]:
        ids, end, n = self.merges.merge(self.buffer), 0, 0
        for n, i in enumerate(ids):
            size = len(self.merges.token_bytes[i])
            if end + size > stable:
                break
            end += size
        else:
            n = len(ids)
        self.buffer = self.buffer[end:]
        return ids[:n]

    def finish(self) -> list[int]:
        ids, self.buffer = self.merges.merge(self.buffer), b""
        return ids


class PretokenCache(dict):
    """Ids of whole pretokens as little-endian bytes."""

    def __init__(self, merges: MergeList):
        super().__init__()
        self.merges = merges

    def __missing__(self, token: str) -> bytes:
        ids = np.array(self.merges.merge(token.encode()), "<u4").tobytes()
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        if len(token) <= 64:
            self[token] = ids
        return ids


class Encoder:
    """Text pieces in, ids (little-endian 32-bit) out; ``finish`` gives the rest.

    Held between pieces: a possible start of a special token, and the last
    pretokens, which the next piece may lengthen or split otherwise. A run too
    long to hold goes on in a ``RunTransducer``."""

    def __init__(self, merges: MergeList, cache: PretokenCache):
        self.merges, self.cache = merges, cache
        self.hold, self.run, self.kind = "", None, ""
        self.special = regex.compile("(" + "|".join(map(regex.escape, merges.specials)) + ")") if merges.specials else None

    def feed(self, piece: str) -> bytes:
        text, out = self.hold + piece, []
        self.hold = ""
        parts = self.special.split(text) if self.special else [text]
        for segment, token in zip(parts[::2], parts[1::2]):
            out.append(self._close(segment))
            out.append(int(self.merges.specials[token]).to_bytes(4, "little"))
        out.append(self._open(parts[-1]))
        return b"".join(out)

    def finish(self) -> bytes:
        text, self.hold = self.hold, ""
        return self._close(text)

    def _close(self, segment: str) -> bytes:
        head, segment = self._continue(segment, True)
        return head + b"".join(map(self.cache.__getitem__, pretokens(segment)))

    def _open(self, tail: str) -> bytes:
        partial = max((n for s in self.merges.specials for n in range(1, len(s)) if tail.endswith(s[:n])), default=0)
        keep, tail = tail[len(tail) - partial:], tail[:len(tail) - partial]
        head, tail = self._continue(tail, False)
        tokens = pretokens(tail)
        if tokens and len(tokens[-1]) > LONG_RUN and not keep:
            last = tokens.pop()
            self.kind = next(k for k, p in _RUNS.items() if k != "other" and p.fullmatch(last[1:])) \
                if any(p.fullmatch(last[1:]) for k, p in _RUNS.items() if k != "other") else "other"
            self.run = RunTransducer(self.merges)
            body = last[:-1] if self.kind == "space" else last
            ready = b"".join(map(self.cache.__getitem__, tokens)) + self._ids(self.run.feed(body.encode()))
            self.hold = last[len(body):]
            return head + ready
        held = tokens[-2:]
        self.hold = "".join(held) + keep
        return head + b"".join(map(self.cache.__getitem__, tokens[:len(tokens) - len(held)]))

    def _continue(self, text: str, last: bool) -> tuple[bytes, str]:
        """Feeds what belongs to the open run; the rest of ``text`` is returned."""
        if self.run is None:
            return b"", text
        end = _RUNS[self.kind].match(text).end()
        if end == len(text) and not last:
            body = text[:-1] if self.kind == "space" else text
            ready = self._ids(self.run.feed(body.encode()))
            return ready, text[len(body):]
        if self.kind == "space" and end < len(text):
            end = max(0, end - 1)  # the last white space before a word is not the run's
        ids = self.run.feed(text[:end].encode()) + self.run.finish()
        self.run = None
        return self._ids(ids), text[end:]

    @staticmethod
    def _ids(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()


class Decoder:
    """Token ids in, text out; an unfinished UTF-8 sequence waits for its rest,
    a broken one becomes U+FFFD."""

    def __init__(self, merges: MergeList):
        self.token_bytes, self.wait = merges.token_bytes, b""

    def feed(self, ids: bytes) -> str:
        data = self.wait + b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        whole = len(data) - self._unfinished(data[-3:])
        self.wait = data[whole:]
        return data[:whole].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.wait = self.wait, b""
        return rest.decode("utf-8", "replace")

    @staticmethod
    def _unfinished(end: bytes) -> int:
        """How many of the last bytes begin a sequence that they do not end."""
        for n in range(1, len(end) + 1):
            lead = end[-n]
            if lead & 0xC0 != 0x80:
                need = 4 if 0xF0 <= lead < 0xF5 else 3 if lead >= 0xE0 else 2 if lead >= 0xC2 else 1
                return n if lead < 0xF5 and need > n else 0
        return 0


def pieces(text: str) -> Iterator[str]:
    for at in range(0, len(text), PIECE):
        yield text[at:at + PIECE]


_MERGES: dict[str, tuple[MergeList, PretokenCache]] = {}


def _forget() -> None:
    _MERGES.clear()


def load(spec: str) -> tuple[MergeList, PretokenCache]:
    """The parsed merge list of this process and its pretoken cache."""
    take_over("bpe_stream", _forget)
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _MERGES:
        merges = MergeList(spec)
        _MERGES[key] = merges, PretokenCache(merges)
    return _MERGES[key]


def encode(spec: str, text: str) -> np.ndarray:
    """All ids of one text (for tests and small uses)."""
    coder = Encoder(*load(spec))
    return np.frombuffer(b"".join([*map(coder.feed, pieces(text)), coder.finish()]), "<u4")


def decode(spec: str, ids: Iterable[int]) -> str:
    coder = Decoder(load(spec)[0])
    return coder.feed(np.array(list(ids), "<u4").tobytes()) + coder.finish()


def _digest(merges: MergeList, cache: PretokenCache, text: str) -> tuple[int, str, str]:
    coder, back = Encoder(merges, cache), Decoder(merges)
    ids_sha, text_sha, n = hashlib.sha256(), hashlib.sha256(), 0
    for ids in (coder.feed(p) for p in pieces(text)):
        ids_sha.update(ids)
        text_sha.update(back.feed(ids).encode())
        n += len(ids) // 4
    rest = coder.finish()
    ids_sha.update(rest)
    text_sha.update((back.feed(rest) + back.finish()).encode())
    return n + len(rest) // 4, ids_sha.hexdigest(), text_sha.hexdigest()


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text: encoded and
    decoded as streams. The tokenizer file (1.5 MB) is read on the driver and
    broadcast; its size does not depend on the data."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, cache = load(spec.value)
        for batch in batches:
            found = [_digest(merges, cache, t or "") for t in map(pa.StringScalar.as_py, batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.int64()),
                 pa.array([x[1] for x in found], pa.string()), pa.array([x[2] for x in found], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return short_batches(docs).select("doc_id", "text").mapInArrow(
        as_task("bpe_stream", _forget, run), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def token_ids(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and the ids themselves, for writers of token files."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [encode(spec.value, t or "").astype("i4") for t in map(pa.StringScalar.as_py, batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))],
                                             names=["doc_id", "token_ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, token_ids array<int>")
