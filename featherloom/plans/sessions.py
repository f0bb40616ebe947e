"""Order and session times as model columns, and columns over other models' predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featherloom.functions import dates, rows
from featherloom.functions.numbers import cyclic, signed_log
from featherloom.operators.encode import quantile_bin


def _calendar(ts: Column, prefix: str) -> dict[str, Column]:
    dow = dates.weekday(ts)
    h_sin, h_cos = cyclic(F.hour(ts), 24)
    d_sin, d_cos = cyclic(dow, 7)
    return {
        f"{prefix}_hour": F.hour(ts), f"{prefix}_day_of_week": dow, f"{prefix}_day_of_month": F.dayofmonth(ts), f"{prefix}_month": F.month(ts),
        f"{prefix}_week_of_year": F.weekofyear(ts), f"{prefix}_is_weekend": dates.is_weekend(ts).cast("int"),
        f"{prefix}_time_of_day": dates.day_part(ts, "session"), f"{prefix}_season": dates.season(F.month(ts)),
        f"{prefix}_hour_sin": h_sin, f"{prefix}_hour_cos": h_cos, f"{prefix}_day_of_week_sin": d_sin, f"{prefix}_day_of_week_cos": d_cos,
    }


def session_features(df: DataFrame, order_ts: str, end_ts: str, hard_call_below: float = 0.0) -> DataFrame:
    """Time columns of an order and its session end; one projection, plus the decile edges."""
    o, e = F.col(order_ts), F.col(end_ts)
    s = dates.seconds_between(e, o)
    cols = {
        "time_to_order_seconds": s, "time_to_order_minutes": s / 60, "time_to_order_hours": s / 3600,
        "ttos_sq": s * s, "ttos_cube": s * s * s, "ttos_log": signed_log(s),
        "ttos_short": (F.abs(s) <= 60).cast("int"), "ttos_medium": ((F.abs(s) > 60) & (F.abs(s) <= 300)).cast("int"), "ttos_long": (F.abs(s) > 300).cast("int"),
        **_calendar(o, "order"), **_calendar(e, "session_end"),
        "same_day_order": (F.to_date(o) == F.to_date(e)).cast("int"), "gap_negative": (s < 0).cast("int"), "hard_call": (s < hard_call_below).cast("int"),
        "is_midnight_session": F.hour(e).isin(0, 1, 2, 3).cast("int"), "order_during_business_hours": F.hour(o).between(9, 18).cast("int"),
        "hour_diff": F.hour(e) - F.hour(o), "order_time_fraction": dates.fraction_of_day(o),
        "ttos_x_hour": s * F.hour(o), "ttos_x_dow": s * dates.weekday(o),
    }
    return quantile_bin(df.withColumns(cols), "time_to_order_seconds", "ttos_decile", 10, source=df.select(s.alias("time_to_order_seconds")))


def prediction_meta(df: DataFrame, models: list[str]) -> DataFrame:
    """Row statistics, ranks, pairwise differences and entropy of several predictions."""
    return df.withColumns({
        "pred_mean": rows.row_mean(models), "pred_min": rows.row_min(models), "pred_max": rows.row_max(models),
        "pred_median": rows.row_median(models), "pred_std": rows.row_std(models),
        **{f"rank_{m}": rows.row_rank(models, m) for m in models}, **rows.abs_differences(models), "pred_entropy": rows.row_entropy(models),
    })
