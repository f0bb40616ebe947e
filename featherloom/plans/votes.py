"""Neighbour votes on a label made of several columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featherloom.functions.strings import join_text
from featherloom.operators import knn


def composite_label_vote(df: DataFrame, key: str, vector: str, parts: list[str], fold: str, k: int) -> DataFrame:
    """Vote of the k nearest rows of other folds on the joined label, split back into its parts.

    No row votes for itself or its own fold, so the vote carries no label of the row.
    """
    labelled = df.withColumn("__label", join_text("_", *[F.col(p) for p in parts]))
    neighbours = knn.nearest(labelled, labelled, key, vector, k, exclude=fold)
    votes = knn.vote(neighbours, labelled, key, "__label", out="vote")
    pieces = F.split("vote", "_", -1)
    return votes.select(key, "vote", *[F.get(pieces, F.lit(i)).cast(df.schema[p].dataType).alias(f"{p}_vote") for i, p in enumerate(parts)])
