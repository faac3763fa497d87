"""Splitting the comma-separated cuisine field into single cuisines.

Two splitters exist in the source queries and they differ:

* ``all_items`` (top cuisines by income): every element of the split,
  trimmed, empties kept, repeats kept (``'A,A'`` is two rows, ``'A,,B,'``
  gives A, '', B, '').
* ``distinct_nonempty_items`` (top cuisines by education): elements that are
  non-empty *before* trimming, then trimmed, counted once per order
  (``'A,,B,'`` gives A, B; ``' '`` survives the test and becomes '').

A NULL cuisine yields no element in both. Both are array expressions inside
the JVM; callers aggregate orders per cuisine string first and explode the
aggregated rows, so the explode never runs at order grain.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_items(cuisine: Column) -> Column:
    return F.transform(F.split(cuisine, ","), lambda x: F.trim(x))


def distinct_nonempty_items(cuisine: Column) -> Column:
    kept = F.filter(F.split(cuisine, ","), lambda x: x != "")
    return F.array_distinct(F.transform(kept, lambda x: F.trim(x)))
