"""Personal data by anchor expansion.

One Aho-Corasick automaton runs over the whole text and reports anchors: at-signs,
schemes, cue words of identifiers, a plus before a digit, a point between digits,
and digits next to each other or one blank or hyphen apart. From an anchor a small
parser of its kind expands to both sides as far as the kind's characters reach and
then validates what it holds. A parser never goes back behind the end of its own
last match, so every character is read a bounded number of times.

Base kinds, the leftmost matches that do not overlap within a kind; a match that
fails its check is dropped and not tried again:

* ``email``: local part, at-sign, domain of two labels or more;
* ``ip``: four numbers of at most 255;
* ``card``: 12 to 19 digits, single blanks or hyphens between them, Luhn's check;
* ``phone``: a plus, 9 to 15 digits with blanks, brackets, points and hyphens.

Further kinds, which the anchors add:

* ``url``: a scheme whose address names a person: user information before the
  host (``ftp://anna@host``), a mail address after ``mailto:`` or ``sip:`` (one
  label is enough there), a number of 7 to 15 digits after ``tel:``;
* ``account``: behind the word IBAN, the longest run of 15 to 34 letters and
  digits, single blanks allowed, that leaves 1 modulo 97; behind "account", "acct"
  or "a/c", an optional "no", "nr" or "number" and signs, a run of 6 to 20 digits,
  single blanks or hyphens between them (cue words count in small, capital and
  title letters);
* ``ssn``: behind SSN or "social security", likewise, three, two and four digits
  with hyphens, whose parts an office could have given out.

Positions are code points, the end exclusive. Spans are ordered by start, then by
kind as listed. Each row is handled alone, in Arrow batches: no shuffle, nothing
is held beyond a batch.

Defined results: null counts as the empty text; texts without data give no spans;
equal rows give equal rows; an empty table gives an empty result; kept columns may
have any name, ``spans`` becomes longer if a kept column is called so.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import arrow_mapped, fresh, quoted

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account", "ssn")
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://", "mailto:", "sip:", "tel:")
CUES = {"iban": "iban", "account": "account", "acct": "account", "a/c": "account", "ssn": "ssn", "social security": "ssn"}
_DIGITS = "0123456789"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_WORD = re.compile(r"[^\W_]")

Span = tuple[str, int, int]


def _anchors() -> ahocorasick.Automaton:
    """Pattern -> (kind of parser, its length)."""
    out = ahocorasick.Automaton()
    out.add_word("@", ("email", 1))
    for a in _DIGITS:
        out.add_word(f"+{a}", ("phone", 2))
        for b in _DIGITS:
            out.add_word(f"{a}.{b}", ("ip", 3))
            for gap in ("", " ", "-"):
                out.add_word(f"{a}{gap}{b}", ("card", 2 + len(gap)))
    for word, kind in (*((s, "url") for s in SCHEMES), *CUES.items()):
        for form in {word, word.upper(), word.capitalize(), word.title()}:
            out.add_word(form, (kind, len(form)))
    out.make_automaton()
    return out


class Finder:
    """The automaton and the parsers. A parser gets the text, the anchor's begin
    and end, and the place before which it may not read; it returns its span, or
    none, and the place up to which the text is settled for its kind."""

    def __init__(self) -> None:
        self.anchors = _anchors()
        self.domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
        self.four = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
        self.fewer = re.compile(r"[0-9]+(?:\.[0-9]+){0,2}")
        self.card_run = re.compile(r"[0-9](?:[ -]?[0-9])+")
        self.phone_run = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
        self.user_host = re.compile(r"[^\s/@?#<>\"']+@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?")
        self.mailbox = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?")
        self.number = re.compile(r"\+?[0-9](?:[().-]?[0-9]){6,14}(?![0-9])")
        self.lead = re.compile(r"(?: ?(?:no|nr|number|No|Nr|Number|NO|NR|NUMBER)\b)?[ .:#=-]{0,4}")
        self.iban = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
        self.account_run = re.compile(r"[0-9](?:[ -]?[0-9]){5,19}(?![0-9])")
        self.ssn_run = re.compile(r"([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9])")
        self.parse: dict[str, Callable[[str, int, int, int], tuple[Span | None, int]]] = {
            k: getattr(self, f"_{k}") for k in ("email", "ip", "card", "phone", "url", "iban", "account", "ssn")}

    def spans(self, text: str) -> list[Span]:
        found: list[Span] = []
        settled = dict.fromkeys(self.parse, 0)
        for last, (kind, size) in self.anchors.iter(text):
            begin = last + 1 - size
            if begin >= settled[kind]:
                span, settled[kind] = self.parse[kind](text, begin, last + 1, settled[kind])
                if span:
                    found.append(span)
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))

    def _email(self, text: str, begin: int, end: int, floor: int) -> tuple[Span | None, int]:
        at = begin
        while begin > floor and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = self.domain.match(text, end) if begin < at else None
        return (("email", begin, domain.end()), domain.end()) if domain else (None, end)

    def _ip(self, text: str, begin: int, end: int, floor: int) -> tuple[Span | None, int]:
        while begin > floor and text[begin - 1] in _DIGITS:
            begin -= 1
        run = self.four.match(text, begin)
        if not run:
            return None, self.fewer.match(text, begin).end()
        own = [p.lstrip("0") for p in run.group().split(".")]
        small = all(len(p) <= 3 and int(p or 0) <= 255 for p in own)
        return ("ip", begin, run.end()) if small else None, run.end()

    def _card(self, text: str, begin: int, end: int, floor: int) -> tuple[Span | None, int]:
        end = self.card_run.match(text, begin).end()
        digits = [ord(c) - 48 for c in text[begin:end] if c in _DIGITS] if end - begin < 38 else []
        odd = sum(digits[-1::-2]) + sum(2 * d - 9 * (d > 4) for d in digits[-2::-2])
        return ("card", begin, end) if 12 <= len(digits) <= 19 and odd % 10 == 0 else None, end

    def _phone(self, text: str, begin: int, end: int, floor: int) -> tuple[Span | None, int]:
        run = self.phone_run.match(text, begin)
        if not run:
            return None, end
        count = sum(map(run.group().count, _DIGITS))
        return ("phone", begin, run.end()) if 9 <= count <= 15 else None, run.end()

    def _url(self, text: str, begin: int, end: int, floor: int) -> tuple[Span | None, int]:
        scheme = text[begin:end].lower()
        if begin and _WORD.match(text[begin - 1]):
            return None, end
        form = self.number if scheme == "tel:" else self.mailbox if scheme in ("mailto:", "sip:") else self.user_host
        run = form.match(text, end)
        return (("url", begin, run.end()), run.end()) if run else (None, end)

    def _value(self, text: str, begin: int, end: int) -> int | None:
        """Where the value behind a cue begins, if the cue is a word of its own."""
        if begin and _WORD.match(text[begin - 1]) or end < len(text) and text[end].isalpha():
            return None
        return self.lead.match(text, end).end()

    def _iban(self, text: str, begin: int, end: int, floor: int) -> tuple[Span | None, int]:
        at = self._value(text, begin, end)
        run = self.iban.match(text, at) if at is not None else None
        for stop in range(run.end(), run.start(), -1) if run else ():
            own = text[at:stop].replace(" ", "")
            if text[stop - 1] != " " and 15 <= len(own) <= 34 and int("".join(str(int(c, 36)) for c in own[4:] + own[:4])) % 97 == 1:
                return ("account", at, stop), stop
        return None, end

    def _account(self, text: str, begin: int, end: int, floor: int) -> tuple[Span | None, int]:
        at = self._value(text, begin, end)
        run = self.account_run.match(text, at) if at is not None else None
        return (("account", at, run.end()), run.end()) if run else (None, end)

    def _ssn(self, text: str, begin: int, end: int, floor: int) -> tuple[Span | None, int]:
        at = self._value(text, begin, end)
        run = self.ssn_run.match(text, at) if at is not None else None
        given = run and run[1] not in ("000", "666") and run[1] < "900" and run[2] != "00" and run[3] != "0000"
        return (("ssn", at, run.end()), run.end()) if given else (None, end)


_FINDER: list[Finder] = []
_SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def personal(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns and ``spans``, an array of (kind, start, end), of
    every row."""
    name = fresh("spans", keep)
    schema = StructType([*(docs.schema[c] for c in keep), StructField(name, _SPANS)])
    sent = keep if text in keep else (*keep, text)  # a kept text travels once
    at, names = sent.index(text), [*keep, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _FINDER:
            _FINDER.append(Finder())
        find = _FINDER[0].spans
        for batch in batches:
            kinds, starts, ends, cuts = [], [], [], [0]
            for value in batch.column(at):
                for kind, begin, end in find(value.as_py() or ""):
                    kinds.append(kind)
                    starts.append(begin)
                    ends.append(end)
                cuts.append(len(kinds))
            rows = pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                                              fields=list(_ARROW.value_type))
            spans = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], spans], names=names)

    return arrow_mapped(docs.select(*map(quoted, sent)), run, schema)


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets;
    spans that overlap give way to the one that begins first, then reaches
    furthest. Null texts stay null."""
    name = fresh("spans", docs.columns)
    found = personal(docs, tuple(docs.columns), text)
    own = F.col(quoted(text))

    def step(done: Column, s: Column) -> Column:
        added = F.concat(done["out"], F.substr(own, done["at"] + 1, s["start"] - done["at"]), F.lit("["), s["kind"], F.lit("]"))
        return F.when(s["start"] < done["at"], done).otherwise(F.struct(s["end"].alias("at"), added.alias("out")))

    first = F.transform(F.col(name), lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["end"].alias("end"), s["kind"].alias("kind")))
    whole = F.aggregate(F.array_sort(first), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                        lambda d: F.concat(d["out"], F.substr(own, d["at"] + 1, F.length(own))))
    return found.select(*(whole.alias(c) if c == text else F.col(quoted(c)) for c in docs.columns))


def listed(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of these kinds, joined by commas."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
