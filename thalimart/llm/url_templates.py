"""URL filter: rules first, then a tree of path templates per host.

Rules such as ``block example.org/es/`` decide the urls they fit (host and all its
subdomains, path prefix; the longest rule wins). What they decide is also the
labelled evidence for the rest:

1. Paths become segments; runs of digits and long hexadecimal runs are typed
   (``<n>``, ``<x>``). Everything from segment ``DEPTH`` + 1 on is one ``**``.
2. Level by level, a branch stays literal if its parent has at most ``FEW``
   different branches or the branch holds ``KEEP`` of the parent's urls;
   otherwise the segment is variable and becomes ``*``. The leaves of this tree
   are the host's templates.
3. Sibling templates whose labelled block rates do not differ (two-proportion
   test at ``Z`` between neighbours in the order of their rates) are merged and
   judged together.
4. A template's block share is smoothed by its host's, and the host's by that of
   all urls; a share above ``REJECT`` blocks. A template without labels has its
   host's share.

Work goes over distinct (host, segments) rows, summed before every shuffle, so a
host with a third of all urls costs what its distinct shapes cost. A parent has at
most ``FEW`` + 1 / ``KEEP`` + 1 templates under it, which bounds the one window.

Defined results: a null url or one without ``://`` has an empty host and path and
is judged as host ``''``; an empty path fits no rule; a row is returned for every
row, repeated and null page ids included; long urls are read whole; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

DEPTH = 4
FEW = 8
KEEP = 0.02
Z = 1.96
#: Weight of the prior in labels, for hosts and templates.
PRIOR = 4.0
REJECT = 0.5


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str      # host and path prefix, such as "example.org/es/"

    @property
    def host(self) -> str:
        return self.text[:self.text.index("/")]

    @property
    def path(self) -> str:
        return self.text[self.text.index("/"):]

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    ascii_upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), ascii_upper, ascii_upper.lower())
    return F.when(at > 0, host).otherwise("")


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    after = F.regexp_replace(F.substr(url, at + 3), "^[^/?#]*", "")
    return F.when(at > 0, F.regexp_extract(after, "^[^?#]*", 0)).otherwise("")


def segments(path: Column) -> Column:
    """The typed segments of a path, at most ``DEPTH`` and a ``**`` for more."""
    typed = F.regexp_replace(F.regexp_replace(path, "[0-9a-f]{16,}", "<x>"), "[0-9]+", "<n>")
    found = F.split(F.regexp_replace(typed, "^/", ""), "/")
    parts = F.when(path == "", F.array().cast("array<string>")).otherwise(found)
    return F.when(F.size(parts) > DEPTH, F.concat(F.slice(parts, 1, DEPTH), F.array(F.lit("**")))).otherwise(parts)


def first_rule(rules: list[Rule], host: Column, path: Column, value) -> Column:
    """value(rule) of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        found = F.when(rule.fits(host, path), F.lit(value(rule))).otherwise(found)
    return found


def templates(shapes: DataFrame) -> DataFrame:
    """shapes (host, segs, n, allow, block) with the template of each."""
    state = shapes.withColumn("t", F.lit(""))
    for level in range(DEPTH + 1):
        seg = F.get("segs", F.lit(level))
        here = state.where(seg.isNotNull()).select("host", "t", seg.alias("s"), "n")
        branch = here.groupBy("host", "t", "s").agg(F.sum("n").alias("n"))
        parent = branch.groupBy("host", "t").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        literal = (F.col("kinds") <= FEW) | (F.col("n") >= KEEP * F.col("total"))
        named = (branch.join(parent, ["host", "t"])
                 .select("host", "t", "s", F.when(literal, F.col("s")).otherwise("*").alias("name")))
        state = (state.withColumn("s", seg).join(named, ["host", "t", "s"], "left")
                 .withColumn("t", F.when(F.col("s").isNull(), F.col("t")).otherwise(F.concat("t", F.lit("/"), "name")))
                 .drop("s", "name"))
        state = written(state, f"templates-{level}")
    return state


def judged(shapes: DataFrame) -> DataFrame:
    """shapes with template t and block_share."""
    state = templates(shapes)
    leaf = state.groupBy("host", "t").agg(*[F.sum(c).alias(c) for c in ("n", "allow", "block")])
    leaf = leaf.withColumn("parent", F.regexp_replace("t", "/[^/]*$", "")).withColumn("labelled", F.col("allow") + F.col("block"))
    rate = F.col("block") / F.col("labelled")
    order = Window.partitionBy("host", "parent").orderBy("rate", "t")
    seen = leaf.where("labelled > 0").withColumn("rate", rate)
    before = {c: F.lag(c).over(order) for c in ("block", "labelled", "rate")}
    pooled = (F.col("block") + before["block"]) / (F.col("labelled") + before["labelled"])
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / before["labelled"]))
    apart = F.when(before["rate"].isNull() | (F.col("rate") - before["rate"] > Z * spread), 1).otherwise(0)
    groups = seen.withColumn("new", apart).withColumn("grp", F.sum("new").over(order))
    merged = groups.groupBy("host", "parent", "grp").agg(F.sum("block").alias("g_block"), F.sum("labelled").alias("g_labelled"))
    known = groups.select("host", "parent", "t", "grp").join(merged, ["host", "parent", "grp"]).select("host", "t", "g_block", "g_labelled")
    hosts = leaf.groupBy("host").agg(F.sum("block").alias("h_block"), F.sum("labelled").alias("h_labelled"))
    whole = leaf.agg(F.coalesce(F.sum("block"), F.lit(0)).alias("b"), F.coalesce(F.sum("labelled"), F.lit(0)).alias("l")).first()
    base = (whole.b + 1.0) / (whole.l + 2.0)
    host_share = (F.col("h_block") + PRIOR * base) / (F.col("h_labelled") + PRIOR)
    share = (F.coalesce("g_block", F.lit(0)) + PRIOR * host_share) / (F.coalesce("g_labelled", F.lit(0)) + PRIOR)
    shares = leaf.join(hosts, "host").join(known, ["host", "t"], "left").select("host", "t", share.alias("block_share"))
    return state.join(shares, ["host", "t"]).select("host", "segs", F.col("t").alias("template"), "block_share")


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict, template, block_share per row."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).select(
        "page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
    host, path = F.col("host"), F.col("path")
    rows = rows.withColumns({"rule": first_rule(rules, host, path, lambda r: r.text),
                             "decided": first_rule(rules, host, path, lambda r: r.verdict), "segs": segments(path)})
    label = {v: F.sum(F.when(F.col("decided") == v, 1).otherwise(0)).alias(v) for v in ("allow", "block")}
    shapes = written(rows.groupBy("host", "segs").agg(F.count(F.lit(1)).alias("n"), label["allow"], label["block"]), "url-shapes")
    found = judged(shapes)
    method = F.when(F.col("block_share") > REJECT, "block").otherwise("allow")
    return rows.join(found, ["host", "segs"]).select(
        "page_id", "host", "path", "rule", F.coalesce("decided", method).alias("verdict"), "template", "block_share")
