"""Out-of-fold predictions, stacking with a second-level model, and sigmoid calibration.

``out_of_fold`` gives every row one prediction per model, made by a fit that
did not see the row's fold. The table is keyed by row and written once; what
is learned on it (a second-level model, a calibration) is free of the leak that
training predictions carry.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import StateModel
from .newton import Fit, fit_logistic_batch
from .score import score


def _predicted(model, df: DataFrame, name: str, task: str) -> DataFrame:
    """The rows with all their columns and the model's score (class 1) or predicted value as ``name``."""
    keep = [F.col(f"`{c}`") for c in df.columns]
    if task == "classification":
        return score(model, df, keep=keep, prediction="prediction", score_col=name).select(*keep, F.col(f"`{name}`"))
    return model.transform(df).select(*keep, F.col("prediction").cast("double").alias(name))


def _kinds(fits: dict, tasks) -> dict:
    return {n: (tasks or {}).get(n, "classification") for n in fits}


def out_of_fold(df: DataFrame, fits: dict, fold_col: str = "fold", tasks: dict | None = None, cut: bool = True) -> DataFrame:
    """``df`` with a column per model: its prediction by the fit on the other folds.

    ``fits``: name -> fit(train) -> model; ``tasks``: name -> 'classification'
    (score of class 1, the default) or 'regression'. Rows without a fold train
    in every fit and are not returned. The frame is written once before the fits
    (``cut=False``: it is written already).
    """
    kinds, df = _kinds(fits, tasks), cut_lineage(df) if cut else df
    folds = sorted(r[0] for r in df.select(fold_col).distinct().where(F.col(fold_col).isNotNull()).collect())      # k values
    parts = []
    for f in folds:
        train, held = df.where(~F.col(fold_col).eqNullSafe(F.lit(f))), df.where(F.col(fold_col) == f)
        for name, fit in fits.items():
            held = _predicted(fit(train), held, name, kinds[name])
        parts.append(held)
    if not parts:
        return functools.reduce(lambda d, n: d.withColumn(n, F.lit(None).cast("double")), fits, df.limit(0))
    return cut_lineage(functools.reduce(DataFrame.unionByName, parts))


class StackModel(StateModel):
    """First-level models and the second-level model on their predictions, as one saved unit."""

    def __init__(self, names=None, tasks=None, models=()):
        super().__init__(None if names is None else {"names": list(names), "tasks": list(tasks)}, models)

    def first_level(self, df: DataFrame) -> DataFrame:
        a = self.learned
        for name, task, m in zip(a["names"], a["tasks"], self.parts):
            df = _predicted(m, df, name, task)
        return df

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.parts[-1].transform(self.first_level(df))


def fit_stack(df: DataFrame, fits: dict, meta, fold_col: str = "fold", tasks: dict | None = None):
    """(StackModel, out-of-fold table). ``meta``: fit(table) -> model, on the columns named like ``fits``.

    The second level learns from out-of-fold predictions; the first-level models of the result are refitted on all rows.
    """
    rows = cut_lineage(df)                                      # read by the out-of-fold fits and the refits
    table = out_of_fold(rows, fits, fold_col, tasks, cut=False)
    top, kinds = meta(table), _kinds(fits, tasks)
    return StackModel(list(fits), [kinds[n] for n in fits], [*(fit(rows) for fit in fits.values()), top]), table


# --- calibration ------------------------------------------------------------

class SigmoidModel(StateModel):
    """``probability`` = 1 / (1 + exp(-(slope * score + offset))), ``prediction`` = probability above a half."""

    def __init__(self, score_col: str | None = None, slope: float = 1.0, offset: float = 0.0):
        super().__init__(None if score_col is None else {"score": score_col, "slope": float(slope), "offset": float(offset)})

    @property
    def slope(self):
        return self.learned["slope"]

    @property
    def offset(self):
        return self.learned["offset"]

    def _transform(self, df: DataFrame) -> DataFrame:
        a = self.learned
        p = 1.0 / (1.0 + F.exp(-(F.lit(a["slope"]) * F.col(f"`{a['score']}`") + F.lit(a["offset"]))))
        return df.withColumns({"probability": p, "prediction": (p > 0.5).cast("double")})


def fit_sigmoid(df: DataFrame, score_col: str = "score", label: str = "label") -> SigmoidModel:
    """Two-parameter logistic fit of the label on a score, with smoothed targets (n1 + 1) / (n1 + 2) and 1 / (n0 + 2).

    A smoothed target is two weighted rows, one of each class; the fit is Newton
    on aggregates. Rows with a null or non-finite score or label take no part.
    """
    s, y = F.col(f"`{score_col}`").cast("double"), F.col(f"`{label}`").cast("double")
    rows = df.select(s.alias("s"), (y > 0).alias("y")).where(s.isNotNull() & ~F.isnan(s) & (F.abs(s) < float("inf")) & y.isNotNull())
    c = rows.agg(F.count_if("y").alias("n1"), F.count_if(~F.col("y")).alias("n0"), F.avg("s").alias("m"), F.stddev_pop("s").alias("d")).first()
    if not c["n1"] + c["n0"]:
        raise ValueError("no complete rows to fit on")
    t = F.when(F.col("y"), F.lit((c["n1"] + 1) / (c["n1"] + 2))).otherwise(F.lit(1 / (c["n0"] + 2)))
    width = c["d"] or 1.0                                       # scores of any scale: the fit sees standard ones
    x = ((F.col("s") - F.lit(c["m"])) / F.lit(width)).alias("x")
    twice = rows.select(x, F.explode(F.array(F.struct(F.lit(1.0).alias("y"), t.alias("w")), F.struct(F.lit(0.0).alias("y"), (1 - t).alias("w")))).alias("r"))
    (m,), _ = fit_logistic_batch(twice.select("x", "r.y", "r.w"), [Fit(C=1e15)], ["x"], "y", weight_col="w", tol=1e-12)
    slope = m.coefficients[0] / width
    return SigmoidModel(score_col, slope, m.intercept - slope * c["m"])


class CalibratedModel(StateModel):
    """A model and the sigmoid of its score, as one saved unit: ``prediction``, ``probability``."""

    def __init__(self, models=()):
        super().__init__({}, models)

    def _transform(self, df: DataFrame) -> DataFrame:
        scored = _predicted(self.parts[0], df, "_score", "classification")
        return self.parts[1].transform(scored).drop("_score")


def calibrate(df: DataFrame, fit, fold_col: str = "fold", label: str = "label") -> CalibratedModel:
    """The sigmoid learned on out-of-fold scores (probabilities or decision values), the model refitted on all rows."""
    rows = cut_lineage(df)
    table = out_of_fold(rows, {"_score": fit}, fold_col, cut=False)
    return CalibratedModel([fit(rows), fit_sigmoid(table, "_score", label)])


def calibration_table(df: DataFrame, probability: str = "probability", label: str = "label", bins: int = 10) -> DataFrame:
    """(bin, n, mean_probability, rate): how often what is predicted happens."""
    b = F.least(F.floor(F.col(probability) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(probability).alias("mean_probability"),
                                          F.avg(F.col(label).cast("double")).alias("rate"))
