"""Array column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def head(col: Column, n: int) -> Column:
    return F.slice(col, 1, n)


def spread(col: Column, names: list[str]) -> list[Column]:
    """One column per position; missing positions are null."""
    return [F.get(col, F.lit(i)).alias(n) for i, n in enumerate(names)]


def arg_max(col: Column) -> Column:
    """Position (from 0) of the first largest element."""
    return (F.array_position(col, F.array_max(col)) - 1).cast("int")


def nearest(col: Column, x: Column) -> Column:
    """Element closest to ``x``; ties give the smallest."""
    pairs = F.transform(col, lambda e: F.struct(F.abs(e - x).alias("d"), e.alias("v")))
    return F.array_min(pairs)["v"]


def all_close(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    close = F.zip_with(a, b, lambda x, y: F.abs(x - y) <= F.lit(atol) + F.lit(rtol) * F.abs(y))
    return (F.size(a) == F.size(b)) & F.forall(close, lambda ok: ok)


def all_equal(a: Column, b: Column) -> Column:
    return a == b


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(col: Column) -> Column:
    """Divided by its euclidean length; a zero vector stays as it is."""
    size = F.sqrt(dot(col, col))
    return F.transform(col, lambda x: F.when(size > 0, x.cast("double") / size).otherwise(x.cast("double")))
