"""Keyword clustering of products and searches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featherloom.operators.encode import keyword_rules, override_by_word


def cluster_texts(df: DataFrame, key: str, text: str, patterns: list[tuple[str, int]], words: DataFrame) -> DataFrame:
    """Cluster by ordered patterns, overridden by single words; -1 when nothing matches.

    ``words`` is a table ``(word, priority, cluster)``, so rules are data and can be long.
    """
    d = override_by_word(df, text, words, key, "__word_cluster")
    return d.withColumn("cluster", F.coalesce("__word_cluster", keyword_rules(F.col(text), patterns))).drop("__word_cluster")
