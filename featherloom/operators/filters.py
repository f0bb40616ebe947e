"""Row filters that need more than one predicate."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featherloom.operators.quantiles import column_quantiles


def time_split(df: DataFrame, ts: str, cutoff: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows before the cut-off and from it on; ``strict`` leaves rows on the cut-off out of both."""
    c = F.lit(cutoff).cast("timestamp")
    later = F.col(ts) > c if strict else F.col(ts) >= c
    return df.where(F.col(ts) < c), df.where(later)


def apply_rule(df: DataFrame, rules: dict[str, Callable[[], Column]], name: str) -> DataFrame:
    """Filter by the one predicate registered under ``name``."""
    if name not in rules:
        raise KeyError(f"no predicate named {name!r}; known: {sorted(rules)}")
    return df.where(rules[name]())


def drop_header_lines(lines: DataFrame, first_field: str) -> DataFrame:
    """Remove header lines from a text column ``value``."""
    return lines.where(~F.col("value").startswith(first_field))


def rows_within_quantiles(df: DataFrame, entity: str, cols: list[str], prob: float = 0.99) -> DataFrame:
    """All rows of entities that have a row with every column at or below its own quantile."""
    limits = column_quantiles(df, {c: [prob] for c in cols})  # one number per column; as literals they reach the scan
    ok = reduce(lambda a, b: a & b, [F.col(c) <= F.lit(limits[c][0]).cast("double") for c in cols])
    return df.join(df.where(ok).select(entity).distinct(), entity, "left_semi")
