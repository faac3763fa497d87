"""Insert-or-ignore as an aggregate: the first staged row per natural key wins.

Written as ``groupBy(key).agg(min(struct(order..., rest...)))`` rather than a
``row_number`` window: the aggregate is partial (map-side combine), so a key
repeated millions of times collapses inside each input task before the
shuffle instead of landing whole in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PACK = "_first_row"


def first_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the smallest by ``order_cols`` (then by the other
    columns, so the pick is deterministic even on ties). Column order kept."""
    keys = list(keys)
    order_cols = list(order_cols)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols + rest])
    picked = df.groupBy(*keys).agg(F.min(packed).alias(_PACK))
    return picked.select(*[F.col(k) if k in keys else F.col(f"{_PACK}.{k}").alias(k)
                           for k in df.columns])
