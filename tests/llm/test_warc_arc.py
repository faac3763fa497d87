"""ARC parsing, conversion and the read-back against a plain computation."""

import hashlib

import pytest

from thalimart.llm import warc_arc as A

SCHEMA = "page_id long, url string, html string, digest string, record int"


def expect(rows):
    size = {i: len((r[2] or "").encode()) for i, r in enumerate(rows)}
    out = []
    for i, (page, _, html, *_) in enumerate(rows):
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        top = max(same, default=None) if size[i] >= 1000 else None
        revisit = top is not None and top != page
        out.append((page, size[i], hashlib.sha1((html or "").encode()).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(map(str, out))


def run(spark, rows, folder):
    pages = spark.createDataFrame(rows, SCHEMA)
    got = A.archive(pages, folder)
    return got, sorted(str(tuple(r)[:5]) for r in got.collect())


def test_round_trip_with_odd_rows(spark, tmp_path):
    big, text = "x\n\r\n\r\n1 0 0 0 5\nWARC/1.0\r\n" * 100, "é" * 600
    rows = [(1, "http://a/b c\n", big, "d", 1), (2, "http://a/é", big, "d", 2), (2, "http://again", big, "d", 3), (3, None, None, None, None),
            (4, "http://x", "", "d", 5), (5, "http://x", "short", "d", 6), (6, "http://x", "short", "d", 7), (None, "http://n", text, "d", 8),
            (-7, "http://n", text, "d", 9), (None, None, "z" * 1000, "d", 10), (8, "http://long", "long " * 400_000, "d", 11), (9, "u", " " + "y" * 999, "d", 12)]
    got, rows_back = run(spark, rows, str(tmp_path))
    assert rows_back == expect(rows)
    ids = {r.page_id: r.record_id for r in got.collect()}
    files = [f for f in (tmp_path / "warc").iterdir() if f.name.startswith("part")]
    records = [x for f in files for x in A.parse_warc(A._content(f.name, f.read_bytes()))]
    assert sum(h["WARC-Type"] == "warcinfo" for h, _ in records) == len(files)
    for h, _ in records:
        if h["WARC-Type"] == "revisit":
            assert h["WARC-Refers-To"] == f"<{ids[int(h['WARC-Refers-To-Page'])]}>"
            assert h["WARC-Date"] == "2000-01-01T00:00:00Z"


def test_empty_table(spark, tmp_path):
    assert run(spark, [], str(tmp_path))[1] == []


def test_pages_table(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    again = rows + [(1000 + r[0], r[1], r[2]) for r in rows[:40]]
    got = A.archive(spark.createDataFrame(again, "page_id long, url string, html string"), str(tmp_path))
    assert sorted(str(tuple(r)[:5]) for r in got.collect()) == expect(again)


def test_arc_files_are_bounded_and_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(A, "FILE_BYTES", 5000)
    rows = [(i, f"http://x/{i}", f"{i:04d}" * (3000 if i == 7 else 200)) for i in range(40)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2).write.parquet(str(tmp_path / "in"))
    sc = spark.sparkContext
    sc.setJobGroup("arc", "")
    try:
        A.write_arc(spark.read.parquet(str(tmp_path / "in")).select("*"), str(tmp_path / "arc"))
        jobs = sc.statusTracker().getJobIdsForGroup("arc")
        stages = [s for j in jobs if (info := sc.statusTracker().getJobInfo(j)) for s in info.stageIds]
    finally:
        sc._jsc.clearJobGroup()
    assert len(stages) == len(jobs)
    files = [A._content(f.name, f.read_bytes()) for f in (tmp_path / "arc").glob("part*")]
    found = [list(A.parse_arc(f)) for f in files]
    assert len(files) > 8 and all(len(f) <= 5000 or len(r) == 1 for f, r in zip(files, found, strict=True))
    assert {f.split(b"\n")[1][:1] for f in files} == {b"1", b"2"}
    assert sorted(r[0] for f in found for r in f) == sorted(r[1] for r in rows)
    for f in files:
        for line in (x for x in f.split(b"\n") if x.startswith(b"http://") and len(x.split()) == 10):
            assert f.index(line) == int(line.split()[7])
    assert sorted(str(tuple(r)[:5]) for r in A.archive(spark.createDataFrame(rows, "page_id long, url string, html string"),
                                                       str(tmp_path / "all")).collect()) == expect(rows)


def test_versions_legacy_dates_and_damage():
    body = b"1 0 archive\nURL IP-address Archive-date Content-type Archive-length\n"
    one = (b"filedesc://old.arc 0.0.0.0 199601010000 text/plain %d\n" % len(body) + body
           + b"\nhttp://a b/c 1.2.3.4 199702031405 text/html 5\nab\n\xff\xfe\n\nhttp://d 1.2.3.4 19970203140506 text/html 0\n\n")
    assert list(A.parse_arc(one)) == [("http://a b/c", "1.2.3.4", "199702031405", "text/html", b"ab\n\xff\xfe"),
                                      ("http://d", "1.2.3.4", "19970203140506", "text/html", b"")]
    assert A.timestamp("199702031405") == "1997-02-03T14:05:00Z" and A.timestamp("19970203140506") == "1997-02-03T14:05:06Z"
    two = A.arc_header(2, "n") + b"\n" + A.arc_record(2, "n", "http://e", "19970203140506", 99, b"body 1\n") + b"\n"
    assert list(A.parse_arc(two)) == [("http://e", "0.0.0.0", "19970203140506", "text/html", b"body 1\n")]
    assert list(A.parse_arc(two[:-4]))[-1][-1] is None
    assert list(A.parse_arc(b"nonsense"))[-1][-1] is None


def test_bytes_that_are_not_utf8_survive(spark, tmp_path):
    body = A.arc_record(1, "n", "http://e", "19970203140506", 0, b"HTTP/1.0 200 OK\r\n\r\n\xff\x00\xfe raw")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_bytes(A.arc_header(1, "n") + b"\n" + body + b"\n")
    A.convert(A.read_arc(spark, str(tmp_path / "in")), str(tmp_path / "out"))
    got = A.read_warc(spark, str(tmp_path / "out")).collect()
    assert [r.payload_digest for r in got] == [hashlib.sha1(b"\xff\x00\xfe raw").hexdigest()]


def test_wrong_lengths_are_refused():
    record = A._warc("response", "u", "n", "d", b"abc", [], "t") + b"\r\n\r\n"
    assert len(list(A.parse_warc(record))) == 1
    with pytest.raises(ValueError):
        list(A.parse_warc(record.replace(b"Content-Length: 3", b"Content-Length: 2")))
