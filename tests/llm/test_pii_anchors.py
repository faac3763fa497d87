"""Anchor expansion against the plain patterns, and the kinds it adds."""

import hashlib
import random
import re

import pytest

from thalimart.llm import queries
from thalimart.llm.pii_anchors import Finder, personal, redacted

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _holds(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def _plain(text):
    found = [(m.start(), i, k, m.end()) for i, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if _holds(k, m.group())]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def _base(text):
    return [s for s in Finder().spans(text) if s[0] in PATTERNS]


def _luhn(digits):
    return digits + str(next(d for d in range(10) if _holds("card", "0" * 12 + digits[-6:] + str(d)) or _holds("card", digits + str(d))))


@pytest.mark.parametrize("pool", [
    ["a", "B9", "@", ".", "-", "_", "%", "+", " ", "é", "x@y.z", "\U0001f642"],
    ["1", "25", "255", "256", "0007", ".", "..", " ", "a", "1.2.3.4", "９"],
    ["4111111111111111", "1", "23", " ", "  ", "-", "--", "a", "378282246310005", "5555 5555-5555 4444", " "],
    ["+", "+1", "(", ")", " ", ".", "-", "555", "12345", "+49 (30) 1234567", "x", "\n"],
    ["@", "a", "1", ".", "+", "-", " ", "4", "255", "(", ")"]])
def test_base_spans_equal_the_plain_patterns(pool):
    find, pick = Finder(), random.Random(len(pool[0]) + len(pool))
    for _ in range(6000):
        text = "".join(pick.choices(pool, k=pick.randrange(0, 30)))
        assert [s for s in find.spans(text) if s[0] in PATTERNS] == _plain(text), repr(text)


def test_hard_cases():
    for text in ("a@b.c@d.e", "a@b..c@d.e", "1.2.3.4.5.6.7.8", "1.2.3", "999.1.1.1.1.1.1", "9" * 5000 + ".1.1.1", "+1", "+12", "@a.b",
                 "1." * 50_000, "a@" * 50_000, "+1 " + "(" * 50_000, "1 " * 50_000, "x" * 100_000 + "@y.z"):
        assert _base(text) == _plain(text), text[:40]


def _of(text, kind):
    return [text[a:b] for k, a, b in Finder().spans(text) if k == kind]


def test_schemes_with_a_person_behind_them():
    assert _of("see ftp://anna:pw@host.org/x and https://example.org/a", "url") == ["ftp://anna:pw@host.org"]
    assert _of("SFTP://bob@box or sftp://example.org", "url") == ["SFTP://bob@box"]
    assert _of("mailto:root@localhost, sip:bob@10.0.0.1. xmailto:a@b", "url") == ["mailto:root@localhost", "sip:bob@10.0.0.1"]
    assert _of("tel:+49-30-1234567 tel:12 hotel:12345678", "url") == ["tel:+49-30-1234567"]


def test_accounts_are_checked_and_bounded():
    assert _of("IBAN: DE89 3704 0044 0532 0130 00 BIC COBADEFF", "account") == ["DE89 3704 0044 0532 0130 00"]
    assert _of("iban GB82WEST12345698765432.", "account") == ["GB82WEST12345698765432"]
    assert _of("IBAN DE89 3704 0044 0532 0130 01", "account") == []
    assert _of("Account no. 1234-5678 90, accountant 1234567, acct: 12345", "account") == ["1234-5678 90"]
    assert _of("SSN: 078-05-1120, ssn 000-12-3456, social security number 666-12-3456, Social Security 219-09-9999", "ssn") == ["078-05-1120", "219-09-9999"]
    assert Finder().spans("The account of the ssn is an iban at 12 and 3.4") == []


def test_query_equals_the_plain_patterns(spark):
    sf = "/root/testdata/sf0.001"
    want = {}
    for doc_id, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        own = _plain(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in own)
        want[doc_id] = (*(sum(s[0] == k for s in own) for k in PATTERNS), hashlib.sha256(joined.encode()).hexdigest(), joined)
    got = queries.QUERIES["op12_pii_anchors"](spark, sf)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want
    assert any(w[0] for w in want.values())


def test_nulls_empty_tables_repeated_rows_and_names(spark):
    rows = [(None, None, 1), (1, "", 2), (2, "a@b.c é 1.2.3.4", 3), (2, "a@b.c é 1.2.3.4", 3), (3, "é" * 200_000 + "a@b.c", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `spans.x` int").withColumnRenamed("spans.x", "spans")
    got = personal(docs, ("doc_id", "spans"))
    assert got.columns == ["doc_id", "spans", "spans_"]
    found = sorted(((r[0] or 0, r[1]), [tuple(s) for s in r[2]]) for r in got.collect())
    two = [("email", 0, 5), ("ip", 8, 15)]
    assert found == [((0, 1), []), ((1, 2), []), ((2, 3), two), ((2, 3), two), ((3, 4), [("email", 200_000, 200_005)])]
    assert personal(docs.limit(0)).count() == 0
    kept = redacted(docs.withColumnRenamed("spans", "a.b")).collect()
    assert sorted((r[0] or 0, r[1] and r[1][-20:]) for r in kept) == [(0, None), (1, ""), (2, "[email] é [ip]"), (2, "[email] é [ip]"), (3, "é" * 13 + "[email]")]


def test_redaction_takes_the_widest_span(spark):
    docs = spark.createDataFrame([("ftp://anna@host.org +1 (555) 555-0100!",)], "text string")
    assert redacted(docs).first()[0] == "[url] [phone]!"
