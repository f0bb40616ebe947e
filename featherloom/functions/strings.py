"""Text column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_pad(col: Column, width: int) -> Column:
    """Left zeros up to ``width``; longer values stay whole."""
    s = col.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def slice_text(col: Column, start: int, stop: int) -> Column:
    """Characters ``start`` to ``stop - 1``, counted from 0."""
    return F.substring(col, start + 1, stop - start)


def split_part(col: Column, sep: str, index: int) -> Column:
    return F.get(F.split(col, sep, -1), F.lit(index))


def capitalize(col: Column) -> Column:
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substring(col, 2, 2**31 - 1)))


def letters(col: Column) -> Column:
    """First run of latin letters and blanks, trimmed."""
    return F.trim(F.regexp_extract(col, r"([a-zA-Z\s]+)", 1))


def contains_any(col: Column, pattern: str) -> Column:
    """Case-insensitive pattern search; missing text does not match."""
    return F.coalesce(F.lower(col).rlike(pattern), F.lit(False))


def has_digit(col: Column) -> Column:
    return col.rlike(r"\d")


def word_count(col: Column) -> Column:
    """Parts between single blanks."""
    return F.size(F.split(col, " ", -1))


def join_text(sep: str, *cols: Column, missing: str = "nan") -> Column:
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit(missing)) for c in cols])


def parsed_int(col: Column) -> Column:
    """Integer of a text that is nothing but an integer, else null."""
    return F.when(col.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(col).try_cast("long"))


def int_between(col: Column, low: int, high: int) -> Column:
    """``low < int(col) < high``; text that is no integer fails."""
    n = parsed_int(col)
    return F.coalesce((n > low) & (n < high), F.lit(False))
