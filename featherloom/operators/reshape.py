"""Pivots, resampling and row sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featherloom.operators.stats import join_groups


def pivot_mean(df: DataFrame, rows: list[str], col: str, values: list, value: str) -> DataFrame:
    return df.groupBy(*rows).pivot(col, values).agg(F.avg(value))


def pivot_unique(df: DataFrame, rows: list[str], col: str, values: list, value: str) -> DataFrame:
    """Pivot without aggregation; a cell with two rows is an error."""
    twice = F.raise_error(F.lit("pivot cell holds more than one row"))
    cells = df.groupBy(*rows, col).agg(F.when(F.count("*") > 1, twice).otherwise(F.first(value)).alias(value))
    return cells.groupBy(*rows).pivot(col, values).agg(F.first(value))


def crosstab_shares(df: DataFrame, row: str, col: str, values: list) -> DataFrame:
    """Share of each listed value within a row."""
    return df.groupBy(row).agg(*[(F.count_if(F.col(col) == v) / F.count("*")).alias(str(v)) for v in values])


def third_of_year(ts: Column) -> Column:
    """0 for January to April, 1 for May to August, 2 for September to December."""
    return F.floor((F.month(ts) - 1) / 4).cast("int")


def fill_periods(df: DataFrame, period: str, step: str) -> DataFrame:
    """Add the periods between the first and the last that have no row."""
    bounds = df.agg(F.min(period).alias("lo"), F.max(period).alias("hi"))
    every = bounds.select(F.explode(F.sequence("lo", "hi", F.expr(f"interval {step}"))).alias(period))
    return every.join(df, period, "left")


def ohlc(df: DataFrame, period: Column, ts: str, tie: str, price: str) -> DataFrame:
    """First, highest, lowest and last price per period, and whether it rose."""
    when = F.struct(ts, tie)
    d = df.groupBy(period.alias("period")).agg(
        F.min_by(price, when).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, when).alias("close"))
    return d.withColumn("color", F.when(F.col("close") >= F.col("open"), "green").otherwise("red"))


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Distinct rows by key, keeping the first in order; aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return picked.select(*keys, *[F.col("__r")[c].alias(c) for c in rest])


def stack_with_flag(parts: dict[str, DataFrame], flag: str) -> DataFrame:
    """Vertical concatenation by column name; missing columns become null and ``flag`` names the part."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [d.withColumn(flag, F.lit(n)) for n, d in parts.items()])


def add_row(df: DataFrame, row: dict) -> DataFrame:
    return df.unionByName(df.sparkSession.createDataFrame([tuple(row[c] for c in df.columns)], df.schema))


def remove_key(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(~F.col(key).eqNullSafe(F.lit(value)))


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows per key, k at most 1000: each task then keeps k rows per key before the shuffle.

    For longer lists number the rows with ``ordered.positions``, which cuts a hot key over many tasks.
    """
    if k > 1000:
        raise ValueError("more than 1000 rows per key: use ordered.positions")
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_words(df: DataFrame, text: str, k: int) -> DataFrame:
    """Most frequent words of a text column; words are runs between white space."""
    words = df.select(F.explode(F.split(F.lower(F.trim(text)), r"\s+")).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(k)
