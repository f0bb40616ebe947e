"""Group aggregates that need a formula or a second level."""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featherloom.functions.dates import month_ordinal
from featherloom.operators.stats import join_groups, with_stats


def conditional_block(df: DataFrame, keys: list[str], groups: dict[str, Column], aggs: dict[str, tuple]) -> DataFrame:
    """Many filtered blocks in one pass.

    ``aggs`` maps a name pattern holding ``{}`` to ``(aggregate function, expression)``; every group
    condition gives one column per pattern.
    """
    cols = [
        fn(F.when(cond, expr)).alias(pattern.format(name))
        for name, cond in groups.items() for pattern, (fn, expr) in aggs.items()
    ]
    return df.groupBy(*keys).agg(*cols)


def unbiased_skew(col: str | Column) -> Column:
    """Bias-corrected skewness; null below three values."""
    n = F.count(col).cast("double")
    return F.when(n > 2, F.skewness(col) * F.sqrt(n * (n - 1)) / (n - 2))


def monthly_trend(df: DataFrame, keys: list[str], ts: str, value: str, out: str) -> DataFrame:
    """Slope of monthly means over month ordinals; 0 with fewer than two months.

    Means are taken to a millionth and summed as whole numbers, so the slope is one division of exact numbers, the same in any order.
    """
    total, n = F.sum(F.round(F.col(value) * 1000000).cast("long")), F.count(value)
    monthly = df.groupBy(*keys, month_ordinal(F.col(ts)).alias("__m")).agg((total * 2 + n).alias("__s"), (n * 2).alias("__n")).where("__n > 0")
    mean = F.expr("(__s - pmod(__s, __n)) div __n").cast("decimal(20,0)")
    x, y, k = F.col("__m").cast("decimal(10,0)"), F.col("__y"), F.count("*").cast("decimal(10,0)")
    over = k * F.sum(x * y).cast("decimal(27,0)") - F.sum(x).cast("decimal(17,0)") * F.sum(y).cast("decimal(20,0)")
    under = k * F.sum(x * x).cast("decimal(20,0)") - F.sum(x).cast("decimal(17,0)") * F.sum(x).cast("decimal(17,0)")
    slope = F.when(F.count("*") > 1, over.cast("double") / under.cast("double") / 1000000.0)
    return monthly.withColumn("__y", mean).groupBy(*keys).agg(F.coalesce(slope, F.lit(0.0)).alias(out))


def weekly_counts(df: DataFrame, keys: list[str], ts: str, prefix: str) -> DataFrame:
    """Mean, sample deviation and maximum of the counts per ISO week number."""
    weekly = df.groupBy(*keys, F.weekofyear(ts).alias("__w")).agg(F.count("*").alias("n"))
    return weekly.groupBy(*keys).agg(
        F.avg("n").alias(f"mean_{prefix}"), F.stddev_samp("n").alias(f"std_{prefix}"), F.max("n").alias(f"max_{prefix}"))


def category_shares(keys_col: str, values: list, prefix: str) -> list[Column]:
    """One-hot means: the share of each listed value."""
    return [F.avg((F.col(keys_col) == v).cast("int")).alias(f"{prefix}_{v}") for v in values]


def value_counts(df: DataFrame, col: str, share: str | None = None) -> DataFrame:
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    if not share:
        return counts
    return with_stats(counts, total=F.sum("n")).select(col, "n", (F.col("n") / F.col("stats.total")).alias(share))


def histogram(df: DataFrame, bin_col: Column, bins: int, weight: Column | None = None) -> DataFrame:
    """Count (or weight sum) per bin: bins ``0 .. bins - 1`` also when empty, and every other bin that occurs."""
    w = weight if weight is not None else F.lit(1)
    sums = df.groupBy(bin_col.cast("long").alias("bin")).agg(F.sum(w).alias("w"))
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return grid.join(sums.where("bin is not null"), "bin", "full").select("bin", F.coalesce("w", F.lit(0)).alias("w"))


def correlations(df: DataFrame, cols: list[str], above: float | None = None) -> DataFrame:
    """Long Pearson matrix of all column pairs from a single aggregation."""
    pairs = list(itertools.combinations(cols, 2))
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    entries = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs]
    out = row.select(F.inline(F.array(*entries)))
    return out.where(F.abs("r") > above) if above is not None else out


def correlations_with(df: DataFrame, target: str, cols: list[str], top: int | None = None) -> DataFrame:
    row = df.agg(*[F.corr(c, target).alias(c) for c in cols])
    out = row.unpivot([], cols, "feature", "r")
    return out.orderBy(F.abs("r").desc_nulls_last(), "feature").limit(top) if top else out


def subset_means(df: DataFrame, subset: Column, cols: list[str]) -> DataFrame:
    """Mean per column inside a subset and overall, with the difference."""
    row = df.agg(*[F.avg(F.when(subset, F.col(c))).alias(f"s_{c}") for c in cols], *[F.avg(c).alias(f"g_{c}") for c in cols])
    entries = [F.struct(F.lit(c).alias("feature"), F.col(f"s_{c}").alias("subset_mean"), F.col(f"g_{c}").alias("global_mean")) for c in cols]
    return row.select(F.inline(F.array(*entries))).withColumn("difference", F.col("subset_mean") - F.col("global_mean"))


def rows_seen_once(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("__n")).where(F.col("__n") == 1).drop("__n")


def column_sums(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.agg(*[F.sum(c).alias(c) for c in cols]).unpivot([], cols, "column", "total")


def sum_of_largest(df: DataFrame, keys: list[str], value: str, n: int, out: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last())
    top = df.select(*keys, value).withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n)
    return top.groupBy(*keys).agg(F.sum(value).alias(out))


def gain_share(dump: DataFrame, model: str, feature: str, gain: str) -> DataFrame:
    """Gain divided by its model's total, summed by feature."""
    totals = dump.groupBy(model).agg(F.sum(gain).alias("__t"))
    d = join_groups(dump, totals, [model])
    return d.groupBy(feature).agg(F.sum(F.col(gain) / F.col("__t")).alias("gain_share"))


def split_usage(dump: DataFrame, feature: str, depth: str, depths: list[int]) -> DataFrame:
    """Splits per feature and depth, weighted by ``1 / 2^(depth - 1)``."""
    counts = dump.groupBy(feature, depth).agg(F.count("*").alias("n"))
    weighted = counts.withColumn("w", F.col("n") / F.pow(F.lit(2.0), F.col(depth) - 1))
    cols = [F.coalesce(F.sum(F.when(F.col(depth) == d, F.col("w"))), F.lit(0.0)).alias(f"depth_{d}") for d in depths]
    return weighted.groupBy(feature).agg(*cols)


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


# approximate distinct counts --------------------------------------------------------------


def distinct_sketches(df: DataFrame, keys: list[str], cols: list[str], size: int = 14) -> DataFrame:
    """One HyperLogLog sketch per group and column, ``sketch_<col>``, to be stored and merged later; 2^size registers.

    Integers, strings and binaries only; nulls do not count. Sketches combine on the map side, so a hot group is no bottleneck.
    """
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(c, F.lit(size)).alias(f"sketch_{c}") for c in cols])


def merged_distinct(sketches: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Approximate distinct counts per group from stored sketches of finer groups, ``approx_<col>``; rows are never read again."""
    return sketches.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{c}", F.lit(False))).alias(f"approx_{c}") for c in cols])
