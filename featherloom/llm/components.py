"""Connected components of a link table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featherloom.session import materialize


def _mark(links: DataFrame) -> tuple[int, int]:
    got = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return got["n"], got["h"]


def star_roots(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that is not the smallest of its component; root is that smallest node.

    Large star: every node hands its larger neighbours to its smallest neighbour. Small star: every node hands its smaller neighbours
    to the smallest of them. Both keep components and end, after a number of rounds that grows with the logarithm of the longest chain,
    when all nodes hang on their root. Links are counted and joined by node, never gathered, and each round is written out.
    """
    links = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _mark(links)
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("n"))
        small = small.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()
        links = materialize(small, "links")
        after = _mark(links)
        if after == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
    raise RuntimeError("components did not settle")
