"""Rules, parsing, and the template tree against a plain recursive version."""

import re
from collections import Counter, defaultdict

from thalimart.llm import url_templates as U
from thalimart.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, host string, segs string, t int"


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule_of(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def segs_of(path):
    if not path:
        return ()
    typed = re.sub(r"[0-9]+", "<n>", re.sub(r"[0-9a-f]{16,}", "<x>", path))
    parts = typed.removeprefix("/").split("/")
    return tuple(parts[:U.DEPTH] + ["**"] if len(parts) > U.DEPTH else parts)


def brute(rows):
    """page rows -> (host, path, rule, verdict), by recursion over each host."""
    parsed = [(parse(u), segs_of(parse(u)[1])) for _, u in rows]
    ruled = [rule_of(*hp) for hp, _ in parsed]
    by_host = defaultdict(list)
    for i, ((host, _), segs) in enumerate(parsed):
        by_host[host].append((segs, i))
    leaf = {}

    def grow(items, level, t, host):
        below = [(s, i) for s, i in items if len(s) > level]
        for s, i in items:
            if len(s) <= level:
                leaf[i] = host, t
        count = Counter(s[level] for s, _ in below)
        names = {k: k if len(count) <= U.FEW or n >= U.KEEP * len(below) else "*" for k, n in count.items()}
        for name in set(names.values()):
            grow([(s, i) for s, i in below if names[s[level]] == name], level + 1, f"{t}/{name}", host)

    for host, items in by_host.items():
        grow(items, 0, "", host)
    stats = defaultdict(lambda: [0, 0])
    hosts = defaultdict(lambda: [0, 0])
    for i, r in enumerate(ruled):
        stats[leaf[i]], hosts[leaf[i][0]]
        if r:
            stats[leaf[i]][r.verdict == "block"] += 1
            hosts[leaf[i][0]][r.verdict == "block"] += 1
    blocked, total = sum(h[1] for h in hosts.values()), sum(map(sum, hosts.values()))
    base = (blocked + 1) / (total + 2)
    families = defaultdict(list)
    for (host, t), (a, b) in stats.items():
        if a + b:
            families[host, re.sub(r"/[^/]*$", "", t)].append((b / (a + b), t, b, a + b))
    merged = {}
    for (host, _), own in families.items():
        own.sort()
        groups = [[own[0]]]
        for x, y in zip(own, own[1:]):
            p = (x[2] + y[2]) / (x[3] + y[3])
            apart = y[0] - x[0] > U.Z * (p * (1 - p) * (1 / x[3] + 1 / y[3])) ** 0.5
            groups.append([y]) if apart else groups[-1].append(y)
        for g in groups:
            for x in g:
                merged[host, x[1]] = sum(y[2] for y in g), sum(y[3] for y in g)
    out = []
    for i, ((host, path), _) in enumerate(parsed):
        a, b = hosts[host]
        prior = (b + U.PRIOR * base) / (a + b + U.PRIOR)
        gb, gl = merged.get(leaf[i], (0, 0))
        share = (gb + U.PRIOR * prior) / (gl + U.PRIOR)
        r = ruled[i]
        out.append((rows[i][0], host, path, r.text if r else None, r.verdict if r else "block" if share > U.REJECT else "allow", leaf[i][1], round(share, 9)))
    return out


def check(spark, rows):
    pages = spark.createDataFrame([(i, u, "h", "s", 1) for i, u in rows], SCHEMA)
    got = [(*tuple(r)[:6], round(r.block_share, 9)) for r in U.judge(pages, URL_RULES).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))
    return got


def test_pages(spark):
    rows = [(r.page_id, r.url) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    got = check(spark, rows)
    assert {"allow", "block"} == {g[4] for g in got}


def test_odd_urls_and_a_wide_host(spark):
    rows = [(1, None), (2, ""), (3, "no scheme/x"), (4, "http://"), (5, "http://ORG/"), (6, "http://Example.ORG?x/es/"), (6, "http://a.example.org/es/1"),
            (None, "https://Éxample.com/de/x#y"), (8, "http://org"), (9, "x://y://z/a"), (10, "http://a.com/" + "s/" * 5000), (11, "http://borg/"),
            (12, "http://example.org/en/1"), (13, "http://example.org/en/2"), (14, "http://a.com//de/")]
    rows += [(100 + i, f"http://w.com/{'de' if i % 3 else 'fr'}/slug-{chr(97 + i % 26)}{chr(97 + i // 26)}/{i}.html") for i in range(200)]
    rows += [(400 + i, f"http://w.com/en/slug{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(120)]
    rows += [(600 + i, f"http://deep.com/{'de' if i % 4 == 0 else 'it'}/a/b/c/d/e/{i}") for i in range(40)]
    got = check(spark, rows)
    assert any("*" in g[5] for g in got)


def test_empty(spark):
    assert check(spark, []) == []
