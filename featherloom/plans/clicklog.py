"""Click-log batch job: filter lines, score them with a fitted model, measure the scores."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featherloom.functions.strings import int_between
from featherloom.operators.joins import checked_pairs
from featherloom.operators.metrics import mae


def keep_rows(rows: DataFrame, field: str = "if1", low: int = 20, high: int = 40) -> DataFrame:
    return rows.where(int_between(F.col(field), low, high))


def predict(model: PipelineModel | Transformer, rows: DataFrame, key: str) -> DataFrame:
    """Score of every row: the probability of class 1, or the prediction of a regression."""
    scored = model.transform(rows)
    prob = vector_to_array("probability")[1] if "probability" in scored.columns else F.col("prediction")
    return scored.select(key, prob.alias("prob"))


def score(pred: DataFrame, truth: DataFrame, key: str, label: str) -> DataFrame:
    """Mean absolute error after checking that both sides hold the same keys once."""
    return checked_pairs(truth, pred, key).agg(mae(F.col(label).cast("double"), F.col("prob")).alias("mae"))
