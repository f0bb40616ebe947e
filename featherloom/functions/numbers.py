"""Numeric column functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def cyclic(col: Column, period: float) -> tuple[Column, Column]:
    angle = col * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def signed_log(col: Column) -> Column:
    return F.signum(col) * F.log1p(F.abs(col))


def guarded_log(col: Column, floor: float = 1e-10) -> Column:
    """``ln`` of the value, at least ``floor``; null stays null."""
    return F.when(col.isNotNull(), F.ln(F.greatest(col, F.lit(floor))))


def clip(col: Column, lo, hi) -> Column:
    return F.when(col.isNotNull(), F.least(F.greatest(col, F.lit(lo) if not isinstance(lo, Column) else lo),
                                           F.lit(hi) if not isinstance(hi, Column) else hi))


def finite(col: Column) -> Column:
    """Infinite and NaN values become null."""
    return F.when(F.abs(col) < F.lit(float("inf")), col)  # NaN counts as larger than infinity


def away_from_zero(col: Column) -> Column:
    return F.signum(col) * F.ceil(F.abs(col))


def toward_zero(col: Column) -> Column:
    return F.signum(col) * F.floor(F.abs(col))


def ratio(a: Column, b: Column) -> Column:
    """Null instead of an error or infinity for a zero divisor."""
    return F.try_divide(a, b)


def eps_ratio(a: Column, b: Column, eps: float = 1e-6) -> Column:
    return a / (b + F.lit(eps))


def match_code(a: Column, b: Column) -> Column:
    """1 for equal, 0 for different, -1 when either side is missing."""
    return F.coalesce((a == b).cast("int"), F.lit(-1))
