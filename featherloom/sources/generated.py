"""Tables generated from the range of a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per date of a one-row ``bounds`` table, with business-day and third-Thursday flags."""
    days = bounds.select(F.explode(F.sequence(F.to_date(first), F.to_date(last))).alias("day"))
    month_start = F.trunc("day", "month")
    third = F.date_add(F.next_day(F.date_sub(month_start, 1), "Thu"), 14)
    return days.select(
        "day",
        (F.weekday("day") < 5).cast("int").alias("is_business_day"),
        (F.col("day") == third).cast("int").alias("is_third_thursday"),
    )


def grid(bounds: DataFrame, width: Column, height: Column) -> DataFrame:
    """All cells ``(x, y)`` with ``0 <= x < width`` and ``0 <= y < height`` of a one-row table, which is read when the plan is built.

    Cells are numbers of a range, which Spark deals over its tasks.
    """
    size = bounds.select(width.cast("long").alias("w"), height.cast("long").alias("h")).first()
    w, h = (max(0, n or 0) for n in (size or (0, 0)))
    return bounds.sparkSession.range(w * h).select(F.expr(f"id div {max(1, h)}L").alias("x"), (F.col("id") % max(1, h)).alias("y"))


def linspace(lo: Column, hi: Column, intervals: int) -> Column:
    """Array of ``intervals + 1`` evenly spaced cut points."""
    return F.transform(F.sequence(F.lit(0), F.lit(intervals)), lambda i: lo + (hi - lo) * i / float(intervals))
