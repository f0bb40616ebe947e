"""Best model per zone of a numeric axis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featherloom.operators.metrics import auc


def zone_models(
    df: DataFrame, axis: str, label: str, models: list[str], width: float,
    overrides: dict[int, str] | None = None,
) -> DataFrame:
    """AUC of every model per zone ``[i * width, (i + 1) * width)`` and the best one (ties: first name).

    Zones with a single class have no AUC and are left out. ``overrides`` fixes the model of a zone.
    """
    long = df.withColumn("zone", F.floor(F.col(axis) / width)).unpivot(["zone", label], models, "model", "score")
    scores = auc(long, label, "score", ["zone", "model"]).where(F.col("auc").isNotNull())
    best = scores.groupBy("zone").agg(
        F.min_by("model", F.struct(-F.round("auc", 9), F.col("model"))).alias("best_model"), F.max("auc").alias("auc"))
    fixed = F.lit(None).cast("string")
    for zone, model in (overrides or {}).items():
        fixed = F.when(F.col("zone") == zone, F.lit(model)).otherwise(fixed)
    return best.withColumn("best_model", F.coalesce(fixed, "best_model"))
