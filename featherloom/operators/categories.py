"""Category statistics per key, all from one ``(key, value)`` count table.

The count table combines before its shuffle, so a hot key arrives as one row per distinct value.
Ties always go to the smaller value. Missing values are not a category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featherloom.operators.stats import join_groups


def category_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def mode_of(value: str, n: str = "n") -> Column:
    return F.min_by(value, F.struct(-F.col(n), F.col(value)))


def entropy(n: str = "n", base_two_eps: float | None = None) -> Column:
    """Shannon entropy of counts in nats, from one pass: ``ln N - sum(n ln n) / N``."""
    return F.ln(F.sum(n)) - F.sum(F.col(n) * F.ln(n)) / F.sum(n)


def category_profile(df: DataFrame, keys: list[str], value: str, prefix: str = "") -> DataFrame:
    """Total, distinct count, mode, its count and share, entropy and stability per key."""
    counts = category_counts(df, keys, value)
    total, top = F.sum("n"), F.max("n")
    return counts.groupBy(*keys).agg(
        total.alias(f"{prefix}total"), F.count("*").alias(f"{prefix}unique"),
        mode_of(value).alias(f"{prefix}mode"), top.alias(f"{prefix}mode_count"),
        (top / total).alias(f"{prefix}concentration"),
        entropy().alias(f"{prefix}entropy"),
        ((total - F.count("*")) / total).alias(f"{prefix}stability"),
    )


def entropy_bits(df: DataFrame, keys: list[str], value: str, out: str, eps: float = 1e-9) -> DataFrame:
    """Entropy in bits with ``eps`` added inside the logarithm."""
    counts = category_counts(df, keys, value)
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("__t"))
    p = F.col("n") / F.col("__t")
    return join_groups(counts, totals, keys).groupBy(*keys).agg((-F.sum(p * F.log2(p + F.lit(eps)))).alias(out))


def summary_of_counts(counts: DataFrame, keys: list[str], value: str, top: int = 2, eps: float = 1e-9) -> DataFrame:
    """All measures of a ``(keys, value, n)`` table at once: distinct values, largest share, entropy in nats and bits, first values.

    One shuffle by key: totals and ranks are windows over a key's distinct values, and the aggregate needs no other partitioning.
    """
    w = Window.partitionBy(*keys)
    d = counts.withColumns({"__t": F.sum("n").over(w), "rank": F.row_number().over(w.orderBy(F.desc("n"), F.col(value)))})
    p = F.col("n") / F.col("__t")
    return d.groupBy(*keys).agg(
        F.count("*").alias("unique"), (F.max("n") / F.sum("n")).alias("concentration"), entropy().alias("entropy"),
        (-F.sum(p * F.log2(p + F.lit(eps)))).alias("bits"), *[F.max(F.when(F.col("rank") == i, F.col(value))).alias(f"top_{i}") for i in range(1, top + 1)])


def _ranked(df: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    # the row_number limit is applied per map task first, so only n rows per key are shuffled
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), F.col(value))
    return category_counts(df, keys, value).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def top_arrays(df: DataFrame, keys: list[str], value: str, n: int, values: str, counts: str) -> DataFrame:
    """The n most frequent values and their counts as arrays (at most n elements each)."""
    rows = F.array_sort(F.collect_list(F.struct("rank", F.col(value).alias("v"), F.col("n"))))
    got = _ranked(df, keys, value, n).groupBy(*keys).agg(rows.alias("__rows"))
    return got.select(*keys, F.transform("__rows", lambda r: r["v"]).alias(values),
                      F.transform("__rows", lambda r: r["n"]).alias(counts))


def top_columns(df: DataFrame, keys: list[str], value: str, n: int, prefix: str) -> DataFrame:
    """The n most frequent values as columns ``<prefix>_1 .. <prefix>_n``."""
    cols = [F.max(F.when(F.col("rank") == i, F.col(value))).alias(f"{prefix}_{i}") for i in range(1, n + 1)]
    return _ranked(df, keys, value, n).groupBy(*keys).agg(*cols)


def measure_by_mode(df: DataFrame, keys: list[str], value: str, measure: Column, inside: str, rest: str | None = None) -> DataFrame:
    """Mean of a measure in the key's most frequent category, and minus the mean elsewhere."""
    modes = category_counts(df, keys, value).groupBy(*keys).agg(mode_of(value).alias("__mode"))
    d = join_groups(df.withColumn("__m", measure), modes, keys)
    is_mode = F.col(value) == F.col("__mode")
    inner = F.avg(F.when(is_mode, F.col("__m")))
    cols = [inner.alias(inside)]
    if rest:
        cols.append((inner - F.avg(F.when(~is_mode, F.col("__m")))).alias(rest))
    return d.groupBy(*keys).agg(*cols)
