"""Whole-table statistics as one-row subqueries, and group statistics joined back to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_stats(df: DataFrame, source: DataFrame | None = None, name: str = "stats", **exprs: Column) -> DataFrame:
    """Add a struct column holding aggregates over all rows of ``source`` (default ``df``).

    The aggregate is a scalar subquery, so it is one row by construction and no window over the
    whole table is needed.
    """
    src = source if source is not None else df
    row = src.agg(F.struct(*[e.alias(n) for n, e in exprs.items()]).alias(name))
    return df.withColumn(name, row.scalar())


def join_groups(df: DataFrame, groups: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Null-safe join of one row per key back to the rows; equal nulls match."""
    right = groups.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return df.join(right, on, how).drop(*[f"__r_{k}" for k in keys])


def with_group_stats(df: DataFrame, keys: list[str], **exprs: Column) -> DataFrame:
    """Add group aggregates to every row.

    Aggregating first and joining back keeps a hot key from being collected in one window
    partition: the aggregate combines before its shuffle and skewed joins are split at run time.
    """
    groups = df.groupBy(*keys).agg(*[e.alias(n) for n, e in exprs.items()])
    return join_groups(df, groups, keys)
