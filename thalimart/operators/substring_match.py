"""First-match substring join: ``text LIKE '%' || pattern || '%'`` (ASCII case
folded), keeping the smallest pattern key per text. ``first_substring_match`` takes
patterns as literal texts, ``first_like_match`` gives ``%`` and ``_`` in them their
LIKE meaning.

Always run at the grain of *distinct texts* (e.g. distinct restaurant cities),
never per fact row, as an equi-join: every pattern is one key (its smallest key
per folded pattern), and every text emits its distinct substrings of the lengths
that patterns have. A pattern occurs in a text exactly when it equals one of
those substrings, so nothing is left to verify, no pattern meets a text that
does not hold it, and work grows with text length x pattern lengths, not with
texts x patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_fold(c: Column) -> Column:
    """Case folding of ASCII letters only (what a NOCASE comparison does)."""
    return F.translate(c, _UPPER, _LOWER)


def first_substring_match(texts: DataFrame, text_col: str, patterns: DataFrame,
                          pattern_col: str, key_col: str) -> DataFrame:
    """Return ``(text_col, key_col)``: for every distinct non-null text with at
    least one matching pattern, the smallest matching pattern key."""
    keys = (patterns.where(F.col(pattern_col).isNotNull())
            .groupBy(ascii_fold(F.col(pattern_col)).alias("_piece")).agg(F.min(key_col).alias("_k")))
    # one row per distinct pattern length: bounded by the longest pattern
    lengths = [r[0] for r in keys.select(F.length("_piece").alias("n")).distinct().collect()]
    t = _substrings(texts, text_col, lengths).drop("_fold")
    return t.join(keys, "_piece").groupBy(text_col).agg(F.min("_k").alias(key_col))


def _substrings(texts: DataFrame, text_col: str, lengths: list[int]) -> DataFrame:
    """text_col, _fold, _piece: the distinct substrings of every distinct text that
    have one of these lengths."""
    pieces = F.expr(
        "array_distinct(flatten(transform(_lengths, m -> transform("
        "sequence(1, greatest(length(_fold) - m + 1, 1)), i -> substring(_fold, i, m)))))")
    return (texts.select(text_col).where(F.col(text_col).isNotNull()).distinct()
            .select(text_col, ascii_fold(F.col(text_col)).alias("_fold"), F.array(*map(F.lit, sorted(lengths))).cast("array<int>").alias("_lengths"))
            .select(text_col, "_fold", F.explode(pieces).alias("_piece")))


def first_like_match(texts: DataFrame, text_col: str, patterns: DataFrame, pattern_col: str, key_col: str) -> DataFrame:
    """``first_substring_match`` with wildcards: ``%`` stands for any text, ``_`` for
    any one character.

    The index of a pattern is its longest piece without a wildcard: a text that
    matches holds that piece, so texts meet patterns by an equi-join on it, and LIKE
    verifies the pairs. Patterns of wildcards alone ask only for a length; the
    smallest key per length is collected (bounded by the longest pattern)."""
    folded = (patterns.where(F.col(pattern_col).isNotNull())
              .groupBy(ascii_fold(F.col(pattern_col)).alias("_pattern")).agg(F.min(key_col).alias("_k")))
    longest = F.aggregate(F.split("_pattern", "[%_]"), F.lit(""), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))
    keys = folded.withColumn("_piece", longest)
    free = keys.where(F.col("_piece") == "").groupBy((F.length("_pattern") - F.length(F.replace("_pattern", F.lit("_"), F.lit("")))).alias("n")).agg(
        F.min("_k").alias("k")).collect()
    keys = keys.where(F.col("_piece") != "")
    lengths = [r[0] for r in keys.select(F.length("_piece")).distinct().collect()]
    escaped = F.replace(F.col("_pattern"), F.lit("\\"), F.lit("\\\\"))
    like = F.expr("_fold LIKE concat('%', _escaped, '%')")
    found = (_substrings(texts, text_col, lengths).join(keys.withColumn("_escaped", escaped), "_piece").where(like)
             .select(text_col, "_k")) if lengths else None
    if free:
        best = F.least(*[F.when(F.length(text_col) >= r.n, F.lit(r.k)) for r in free], F.lit(None))
        own = texts.select(text_col).where(F.col(text_col).isNotNull()).distinct().select(text_col, best.alias("_k")).where(F.col("_k").isNotNull())
        found = own if found is None else found.unionByName(own)
    if found is None:
        found = texts.select(text_col).where(F.lit(False)).withColumn("_k", F.lit(None).cast(patterns.schema[key_col].dataType))
    return found.groupBy(text_col).agg(F.min("_k").alias(key_col))
