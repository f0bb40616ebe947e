"""Date and time column functions. Weekdays count from Monday = 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: (first hour, label) per profile, in order; hours before the first get the last label
DAY_PARTS = {
    "client": [(5, "morning"), (12, "day"), (17, "evening"), (22, "night")],
    "client_closed": [(5, "morning"), (13, "day"), (18, "evening"), (23, "night")],
    "session": [(7, "morning"), (13, "afternoon"), (19, "evening"), (24, "night")],
    "shop": [(6, "morning"), (12, "day"), (18, "rest")],
}


def day_part(ts: Column, profile: str = "client") -> Column:
    """Label of the hour: each label starts at its first hour."""
    parts = DAY_PARTS[profile]
    hour = F.hour(ts)
    label = F.lit(parts[-1][1])
    for start, name in parts:
        label = F.when(hour >= start, F.lit(name)).otherwise(label)
    return label


def weekday(ts: Column) -> Column:
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def part_of_month(ts: Column) -> Column:
    day = F.dayofmonth(ts)
    return F.when(day <= 10, "early").when(day <= 20, "middle").otherwise("late")


def season(month: Column) -> Column:
    return (F.when(month.isin(12, 1, 2), "winter").when(month.isin(3, 4, 5), "spring")
            .when(month.isin(6, 7, 8), "summer").otherwise("autumn"))


def month_ordinal(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts)


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def whole_days(later: Column, earlier: Column) -> Column:
    """Complete 24-hour days, cut toward zero."""
    return ((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(86_400_000_000)).cast("long")


def fraction_of_day(ts: Column) -> Column:
    return (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))) / F.lit(86400.0)


def on_dates(ts: Column, days: list[str]) -> Column:
    return F.to_date(ts).isin([F.lit(d).cast("date") for d in days])


def day_window(ts: Column, end: str, days: int) -> Column:
    """Dates ``end - days`` to ``end``, both included, as a range on the raw timestamp."""
    stop = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp")
    start = F.date_sub(F.lit(end).cast("date"), days).cast("timestamp")
    return (ts >= start) & (ts < stop)


def half_open_window(ts: Column, end: str, days: int) -> Column:
    """Dates from ``end - days`` up to but without ``end``."""
    stop = F.lit(end).cast("date")
    return (ts >= F.date_sub(stop, days).cast("timestamp")) & (ts < stop.cast("timestamp"))
