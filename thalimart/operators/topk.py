"""Top-k helpers over already-aggregated frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group_cols: Sequence[str], order_by: Sequence[Column],
                    n: int, rank_col: str = "_rank") -> DataFrame:
    """Rows ranked 1..n inside each group (``order_by`` must be total, so ties
    resolve the same way everywhere). The rank filter becomes a group limit
    before the shuffle (``WindowGroupLimit``): a task passes on at most n rows
    of a group.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_by)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def with_group_total(df: DataFrame, group_cols: Sequence[str], value_col: str,
                     total_col: str) -> DataFrame:
    """Add the group's sum of ``value_col``: a partial aggregate (one row per
    group) joined back, instead of a window that would hold the group in one
    task."""
    totals = df.groupBy(*group_cols).agg(F.sum(value_col).alias(total_col))
    return df.join(totals, list(group_cols))


def rows_at_group_max(df: DataFrame, group_cols: Sequence[str], value_col: str,
                      groups_bounded: bool = False) -> DataFrame:
    """Every row whose ``value_col`` equals the maximum of its group (ties kept).

    The maximum comes from a partial aggregate (one row per group), joined back
    on the group keys, so a group with many rows never sits in one task the way
    a max-window over it would. ``groups_bounded=True`` (the caller knows the
    number of groups is fixed, e.g. a filtered list of years) broadcasts the
    maxima, so a hot group is never a shuffle partition of the join either.
    """
    best = df.groupBy(*group_cols).agg(F.max(value_col).alias("_group_max"))
    if groups_bounded:
        best = F.broadcast(best)
    return (df.join(best, list(group_cols))
            .where(F.col(value_col) == F.col("_group_max"))
            .drop("_group_max"))
