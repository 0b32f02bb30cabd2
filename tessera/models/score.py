"""Scoring and feature importance."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def score(model, df: DataFrame, keep=(), prediction: str = "prediction", score_col: str = "score") -> DataFrame:
    """Class, probability of class 1 (``probability[1]``) or, for
    models without probabilities (LinearSVC), the decision value
    (``rawPrediction[1]``), as plain columns next to ``keep``."""
    out = model.transform(df)
    cols = out.columns
    if "probability" in cols and dict(out.dtypes)["probability"] == "vector":
        s = vector_to_array("probability")[1]
    elif "probability" in cols:
        s = F.col("probability")
    elif "rawPrediction" in cols:
        s = vector_to_array("rawPrediction")[1]
    else:
        s = F.col(prediction)
    return out.select(*keep, F.col(prediction).cast("int").alias(prediction), s.cast("double").alias(score_col))


def predict_values(model, df: DataFrame, keep=(), prediction: str = "prediction") -> DataFrame:
    """L13 for regressors: the predicted value next to ``keep``."""
    return model.transform(df).select(*keep, F.col(prediction).cast("double").alias(prediction))


def feature_importance(model, names, k: int | None = 20, spark=None) -> DataFrame:
    """(feature, importance) sorted by importance (ties by name), top k.
    The importance vector is model state of one value per feature."""
    imp = model.featureImportances.toArray().tolist()
    rows = sorted(zip(names, imp), key=lambda r: (-r[1], r[0]))
    if k:
        rows = rows[:k]
    spark = spark or SparkSession.getActiveSession()
    return spark.createDataFrame([(n, float(v), i + 1) for i, (n, v) in enumerate(rows)],
                                 "feature string, importance double, position int")
