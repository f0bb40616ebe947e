"""Column profiles. All columns are turned into one long (column, value, count) table, so every
measure of every column comes from one counted shuffle instead of one job per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featherloom.operators.ordered import group_quantiles, quantiles_of_counts

DISTINCT_LIMIT = 55  # fixed value: fewer distinct values make a column categorical


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def long_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(column, value as text, number, n)`` for every distinct value of every column, nulls included.

    Numbers are counted as numbers and turned into text afterwards, once per distinct value.
    """
    cells = []
    for f in df.schema.fields:
        if cols and f.name not in cols:
            continue
        c, kind = F.col(f.name), f.dataType
        whole, exact = isinstance(kind, T.IntegralType), isinstance(kind, T.DoubleType)
        cells.append(F.struct(
            F.lit(f.name).alias("column"), F.lit(kind.simpleString()).alias("dtype"),
            (c.cast("long") if whole else F.lit(None).cast("long")).alias("__whole"),
            (c.cast("double") if _is_number(kind) and not whole else F.lit(None).cast("double")).alias("__real"),
            (F.lit(None).cast("string") if whole or exact else c.cast("string")).alias("__text")))
    counts = df.select(F.inline(F.array(*cells))).groupBy("column", "dtype", "__whole", "__real", "__text").agg(F.count("*").alias("n"))
    value = F.coalesce("__text", F.col("__whole").cast("string"), F.col("__real").cast("string"))
    return counts.select("column", "dtype", value.alias("value"), F.coalesce("__real", F.col("__whole").cast("double")).alias("number"), "n")


def _summary(counts: DataFrame, candidate: Column) -> DataFrame:
    def total(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))

    v, x, n = F.col("value"), F.col("number"), F.col("n")
    return counts.groupBy("column", "dtype").agg(
        F.sum(n).alias("rows"), F.count("*").alias("n_unique"), F.count("value").alias("n_values"),
        total(v.isNull()).alias("null_count"), total(x == 0).alias("zero_count"), total(v == "").alias("empty_count"),
        F.max(F.when(candidate, n)).alias("mode_count"),
        F.min_by(F.when(candidate, v), F.when(candidate, F.struct(-n, x, v))).alias("mode"),
        F.sum(F.when(candidate, n)).alias("mode_base"),
        F.min(F.when(v.isNotNull(), F.struct(x, v)))["value"].alias("example"),
    )


def column_info(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Distinct count, null/zero/empty shares, mode (of values that are not null, 0 or empty) with its
    share among those, and a trash score."""
    v, x = F.col("value"), F.col("number")
    real = v.isNotNull() & F.coalesce(x != 0, F.lit(True)) & (v != "")
    s = _summary(long_counts(df, cols), real)
    shares = {"nan_frac": F.col("null_count") / F.col("rows"), "zero_frac": F.col("zero_count") / F.col("rows"),
              "empty_frac": F.col("empty_count") / F.col("rows"),
              "mode_frac": F.round(F.try_divide(F.col("mode_count").cast("double"), F.col("mode_base").cast("double")), 2)}
    d = s.withColumns(shares)
    top = F.greatest(*shares)
    return d.select(
        "column", "dtype", "n_unique", "example", F.col("mode").alias("mode_el"), *shares,
        F.greatest(F.coalesce(F.col("mode_frac"), F.lit(0.0)) - top, top).alias("trash_score"))


def column_info_by_threshold(df: DataFrame, threshold: float = 0.5, cols: list[str] | None = None) -> DataFrame:
    """Like :func:`column_info`, but the mode is over all present values and counts only above a threshold."""
    s = _summary(long_counts(df, cols), F.col("value").isNotNull())
    share = F.col("mode_count") / F.col("rows")
    bad = (F.col("null_count") + F.col("zero_count") + F.col("empty_count")) / F.col("rows")
    return s.select(
        "column", "dtype", "n_unique", (F.col("null_count") / F.col("rows")).alias("nan_frac"),
        (F.col("zero_count") / F.col("rows")).alias("zero_frac"), (F.col("empty_count") / F.col("rows")).alias("empty_frac"),
        F.col("mode").alias("mode_el"), share.alias("mode_frac"),
        F.greatest(bad, F.when(share > threshold, share).otherwise(0.0)).alias("trash_score"))


def _moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean, sample deviation, minimum and maximum per numeric column, from one aggregate over the rows."""
    cells = []
    for c in cols:
        x = F.col(c).cast("double")
        cells.append(F.struct(F.lit(c).alias("column"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")))
    if not cells:
        return df.sparkSession.createDataFrame([], "column string, mean double, std double, min double, max double")
    return df.agg(F.array(*cells).alias("m")).select(F.inline("m"))


def info_table(df: DataFrame, distinct_limit: int = DISTINCT_LIMIT, cols: list[str] | None = None) -> DataFrame:
    """Count, moments, quantiles, range, distinct count, mode and null share per column.

    Moments and quantiles are given for numeric columns with at least ``distinct_limit`` values.
    """
    names = cols or df.columns
    counts = long_counts(df, names)
    s = _summary(counts, F.col("value").isNotNull())
    numbers = counts.where(F.col("number").isNotNull())
    moments = _moments(df, [f.name for f in df.schema.fields if f.name in names and _is_number(f.dataType)])
    marks = quantiles_of_counts(numbers, ["column"], "number", "n", {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95})
    d = s.join(moments, "column", "left").join(marks, "column", "left")
    is_num = (F.col("n_values") >= distinct_limit) & F.col("mean").isNotNull()
    shown = {c: F.when(is_num, F.round(c, 1)) for c in ("mean", "std", "min", "q25", "q50", "q75", "q95", "max")}
    return d.select(
        "column", "dtype", (F.col("rows") - F.col("null_count")).alias("count"), *[e.alias(c) for c, e in shown.items()],
        F.when(is_num, F.round(F.col("max") - F.col("min"), 1)).alias("iqr"), F.col("n_values").alias("nunique"), "mode",
        "mode_count", F.round(F.col("mode_count") * 100 / F.col("rows"), 1).alias("mode_pct"),
        "null_count", F.round(F.col("null_count") * 100 / F.col("rows"), 1).alias("null_pct"))


def classify_columns(df: DataFrame, distinct_limit: int = DISTINCT_LIMIT) -> DataFrame:
    """Categorical with fewer than ``distinct_limit`` values, else numerical."""
    d = long_counts(df).groupBy("column").agg(F.count("value").alias("nunique"))
    return d.withColumn("kind", F.when(F.col("nunique") < distinct_limit, "categorical").otherwise("numerical"))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, deviation, quartiles and range of numeric columns."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("number")) for c in cols]
    long = df.select(F.inline(F.array(*cells)))
    moments = long.groupBy("column").agg(
        F.count("number").alias("count"), F.avg("number").alias("mean"), F.stddev_samp("number").alias("std"),
        F.min("number").alias("min"), F.max("number").alias("max"))
    return moments.join(group_quantiles(long, ["column"], "number", {"q25": 0.25, "q50": 0.5, "q75": 0.75}), "column")


def shares_by_class(df: DataFrame, hue: str, cols: list[str], tolerance: float = 1.0) -> DataFrame:
    """Per class and column: share of values within ``tolerance`` of zero, and of nulls."""
    aggs = []
    for c in cols:
        aggs += [F.avg((F.coalesce(F.abs(c) <= tolerance, F.lit(False))).cast("int")).alias(f"z_{c}"), F.avg(F.col(c).isNull().cast("int")).alias(f"n_{c}")]
    wide = df.groupBy(hue).agg(*aggs)
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"z_{c}").alias("zero_share"), F.col(f"n_{c}").alias("null_share")) for c in cols]
    return wide.select(hue, F.inline(F.array(*cells)))


def class_histogram(df: DataFrame, hue: str, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Rows per class in ``bins`` equal-width bins; the last bin includes ``hi``."""
    i = F.least(F.floor((F.col(col) - lo) / ((hi - lo) / bins)), F.lit(bins - 1))
    return df.where(F.col(col).between(lo, hi)).groupBy(i.alias("bin"), hue).agg(F.count("*").alias("n"))


def labelled_counts(df: DataFrame, col: str) -> DataFrame:
    """Category counts with readable names for missing and empty text."""
    c = F.col(col).cast("string")
    name = F.when(c.isNull(), "<NAN>").when(c == "", "<EMPTY>").otherwise(c)
    return df.groupBy(name.alias("value")).agg(F.count("*").alias("n"))


def merge_rare(df: DataFrame, col: str, min_share: float = 0.01, other: str = "Other") -> DataFrame:
    """Values below a share of all rows become ``other``."""
    counts = df.groupBy(col).agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    keep = counts.where(F.col("__n") / total >= min_share).select(F.col(col).alias("__kept"))
    d = df.join(keep, F.col(col) == F.col("__kept"), "left")
    return d.withColumn(col, F.coalesce("__kept", F.lit(other))).drop("__kept")
