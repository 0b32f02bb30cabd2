"""Gaussian naive Bayes as aggregates and a projection (L3).

Fit = per class: count, mean and population variance of every feature (one
``groupBy(label)`` with partial aggregation). The model is a table of
#classes rows; scoring is a projection with the parameters joined in as
literals -- the whole thing is expressible in SQL, so it is oracle-checked.
Variance smoothing as sklearn: ``var + 1e-9 * max(feature variance)``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import FitEstimator, StateModel

#: a label with more distinct values is taken for a mistake
MAX_CLASSES = 10_000

class GaussianNBModel(StateModel):
    def __init__(self, classes: list[dict] | None = None, features: list[str] | None = None, eps: float = 0.0):
        super().__init__(None if classes is None else {"classes": classes, "features": features, "eps": eps})

    @staticmethod
    def log_joint(c: dict, features: list[str], eps: float):
        terms = [F.lit(math.log(c["prior"]))]
        for f in features:
            var = c[f"{f}__var"] + eps
            terms.append(F.lit(-0.5 * math.log(2 * math.pi * var))
                         - (F.col(f) - F.lit(c[f"{f}__mean"])) ** 2 / F.lit(2 * var))
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out

    def _transform(self, df: DataFrame, prediction: str = "prediction", probability: str = "probability") -> DataFrame:
        """Adds ``prediction`` (arg-max class, ties -> first class) and, for
        two classes, ``probability`` of the second (larger) class."""
        learned = self.learned
        labels = [c["label"] for c in learned["classes"]]
        lj = {c["label"]: self.log_joint(c, learned["features"], learned["eps"]) for c in learned["classes"]}
        out = df.withColumns({f"_lj{i}": lj[lab] for i, lab in enumerate(labels)})
        best = F.lit(labels[0])
        best_v = F.col("_lj0")
        for i in range(1, len(labels)):
            better = F.col(f"_lj{i}") > best_v
            best = F.when(better, F.lit(labels[i])).otherwise(best)
            best_v = F.greatest(best_v, F.col(f"_lj{i}"))
        out = out.withColumn(prediction, best)
        if len(labels) == 2:
            out = out.withColumn(probability, 1.0 / (1.0 + F.exp(F.col("_lj0") - F.col("_lj1"))))
        return out.drop(*[f"_lj{i}" for i in range(len(labels))])


def fit_gaussian_nb(df: DataFrame, features, label: str = "label", var_smoothing: float = 1e-9) -> GaussianNBModel:
    features = list(features)
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"),
                              *[x for f in features for x in (F.avg(f).alias(f"{f}__mean"),
                                                              F.var_pop(f).alias(f"{f}__var"))])
    allvar = df.agg(*[F.var_pop(f).alias(f) for f in features]).first()
    eps = var_smoothing * max([allvar[f] or 0.0 for f in features] + [0.0])
    rows = g.where(F.col(label).isNotNull()).limit(MAX_CLASSES + 1).collect()  # one row per class
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values: not a class label")
    rows = sorted((r.asDict() for r in rows), key=lambda r: r[label])
    n = sum(r["_n"] for r in rows)
    classes = [dict(r, label=r[label], prior=r["_n"] / n) for r in rows]
    return GaussianNBModel(classes, features, eps)


class GaussianNB(FitEstimator):
    """``GaussianNB(features=[...], label='label', var_smoothing=1e-9)`` as an ``ml`` estimator."""

    def _fit(self, df: DataFrame) -> GaussianNBModel:
        return fit_gaussian_nb(df, **self.options)
