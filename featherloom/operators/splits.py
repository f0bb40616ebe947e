"""Samples and splits. Random choices come from a hash of the row's key and a seed, so they do not
change with partitioning, retries or lost executors."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featherloom.operators.ordered import positions
from featherloom.operators.stats import join_groups, with_stats


def hash_uniform(keys: list[str], seed: int) -> Column:
    """Repeatable number in (0, 1): 52 bits of a digest of the key columns and the seed."""
    digest = F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def exact_split(df: DataFrame, key: str, test_share: float, seed: int, flag: str = "is_train") -> DataFrame:
    """Exactly ``int(n * (1 - test_share))`` rows get flag 1."""
    d = positions(df.withColumn("__u", hash_uniform([key], seed)), [], ["__u", key], "__pos")
    d = with_stats(d, df, "__s", n=F.count("*"))
    size = F.floor(F.col("__s.n") * F.lit(1 - test_share))
    return d.withColumn(flag, (F.col("__pos") <= size).cast("int")).select(*df.columns, flag)


def stratified_split(df: DataFrame, key: str, label: str, test_share: float, seed: int, flag: str = "is_train") -> DataFrame:
    """The same share of every label."""
    d = positions(df.withColumn("__u", hash_uniform([key], seed)), [label], ["__u", key], "__pos")
    d = join_groups(d, df.groupBy(label).agg(F.count("*").alias("__n")), [label])
    return d.withColumn(flag, (F.col("__pos") <= F.floor(F.col("__n") * F.lit(1 - test_share))).cast("int")).select(*df.columns, flag)


def random_folds(df: DataFrame, key: str, k: int, seed: int, fold: str = "fold") -> DataFrame:
    """Fold 0 .. k-1 of a row's key; no shuffle. A group column as key keeps groups together."""
    return df.withColumn(fold, F.floor(hash_uniform([key], seed) * k).cast("int"))


def stratified_folds(df: DataFrame, key: str, label: str, k: int, fold: str = "fold", seed: int | None = None) -> DataFrame:
    """Rows of each label dealt out to the folds in key order, or in random order with a ``seed``."""
    d = df if seed is None else df.withColumn("__u", hash_uniform([key], seed))
    d = positions(d, [label], [key] if seed is None else ["__u", key], "__pos")
    return d.withColumn(fold, ((F.col("__pos") - 1) % k).cast("int")).drop("__pos", "__u")


def time_folds(df: DataFrame, ts: str, key: str, k: int, fold: str = "fold") -> DataFrame:
    """k + 1 equal blocks in time order; block i is the test part after training on all blocks before it."""
    d = positions(df, [], [ts, key], "__pos")
    d = with_stats(d, df, "__s", n=F.count("*"))
    block = F.floor((F.col("__pos") - 1) * (k + 1) / F.col("__s.n"))
    return d.withColumn(fold, block.cast("int")).select(*df.columns, fold)


def poisson_edges(mean: float) -> list[float]:
    """Probability of at most 0, 1, ... events, until what lies beyond is below the hash's resolution of 2 ** -52."""
    edges, term, n = [], math.exp(-mean), 0
    while not edges or 1 - edges[-1] > 2**-53 and (n <= mean or term > 2**-60):
        edges.append((edges[-1] if edges else 0.0) + term)
        n += 1
        term *= mean / n
    return edges


POISSON_STEP = 8.0  # larger means are sums of independent numbers with at most this mean


def poisson_count(keys: list[str], seed: int, mean: float = 1.0) -> Column:
    """How often a row is drawn in a bootstrap sample: a Poisson number from its hash, without an upper bound."""
    parts = max(1, math.ceil(mean / POISSON_STEP))
    edges = F.array(*[F.lit(e) for e in poisson_edges(mean / parts)])

    def one(i: int) -> Column:
        u = hash_uniform(keys, seed if i == 0 else seed + 1_000_003 * i)
        return F.size(F.filter(edges, lambda e: e <= u))

    return reduce(lambda a, b: a + b, [one(i) for i in range(parts)])


def sample_rows(df: DataFrame, key: str, share: float, seed: int, replacement: bool = False) -> DataFrame:
    """A share of the rows; with replacement a row appears as often as it is drawn."""
    if not replacement:
        return df.where(hash_uniform([key], seed) < share)
    drawn = poisson_count([key], seed, share)
    return df.withColumn("__n", drawn).where("__n > 0").withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__n")))).drop("__n", "__i")


def bootstrap_n(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` draws with replacement, as rows with ``draw`` 0 to n - 1: each draw's random number picks a row number."""
    numbered = with_stats(positions(df, [], [key], "__pos"), df, "__s", n=F.count("*"))
    draws = df.sparkSession.range(n).withColumnRenamed("id", "draw").withColumn("__u", hash_uniform(["draw"], seed))
    draws = with_stats(draws, df, "__d", n=F.count("*")).select("draw", (F.floor(F.col("__u") * F.col("__d.n")) + 1).alias("__pick"))
    return draws.join(numbered, F.col("__pick") == F.col("__pos")).select("draw", *df.columns)


def sample_n(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    return df.withColumn("__u", hash_uniform([key], seed)).orderBy("__u", key).limit(n).drop("__u")


def one_per_class(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    rest = [c for c in df.columns if c != label]
    d = df.groupBy(label).agg(F.min_by(F.struct(*rest), F.struct(hash_uniform([key], seed), F.col(key))).alias("__r"))
    return d.select(label, *[F.col("__r")[c].alias(c) for c in rest])


def capped_per_class(df: DataFrame, key: str, label: str, caps: dict, seed: int) -> DataFrame:
    """At most ``caps[label]`` random rows of each listed label."""
    d = df.where(F.col(label).isin(list(caps))).withColumn("__u", hash_uniform([key], seed))
    d = positions(d, [label], ["__u", key], "rank")
    limit = F.lit(0)
    for value, cap in caps.items():
        limit = F.when(F.col(label) == value, F.lit(cap)).otherwise(limit)
    return d.where(F.col("rank") <= limit).select(*df.columns)


def shuffled(df: DataFrame, key: str, seed: int, out: str = "pos") -> DataFrame:
    """Rows numbered in a seeded random order."""
    d = positions(df.withColumn("__u", hash_uniform([key], seed)), [], ["__u", key], out)
    return d.drop("__u")


def bernoulli(key: str, p: float, seed: int) -> Column:
    return (hash_uniform([key], seed) < p).cast("int")
