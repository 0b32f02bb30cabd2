"""Linear models through ``pyspark.ml`` with the reference's parameter
conventions translated (L1, L2, L9-L12).

The translations were fitted against closed forms / solver outputs (see
SURVEY notes): sklearn's ``C`` scales a *sum* of losses, Spark's
``regParam`` a weighted *mean*, hence ``regParam = 1 / (C * sum(w))``.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import FitEstimator, StateModel

from ..operators.encode import assemble


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class: one small aggregate, k rows (a label column has few
    classes by definition)."""
    return {r[0]: r[1] for r in df.groupBy(label).agg(F.count(F.lit(1))).collect()}


def balanced_weights(df: DataFrame, label: str, out: str = "weight", counts: dict | None = None) -> DataFrame:
    """``class_weight='balanced'``: w_c = n / (k * n_c), as a CASE
    expression over the k class counts (no join)."""
    counts = counts or class_counts(df, label)
    n, k = sum(counts.values()), len(counts)
    expr = None
    for c, nc in counts.items():
        cond = F.col(label).isNull() if c is None else (F.col(label) == F.lit(c))
        w = F.lit(n / (k * nc))
        expr = F.when(cond, w) if expr is None else expr.when(cond, w)
    return df.withColumn(out, expr)


def _size_and_weight(df: DataFrame, weight_col: str | None) -> float:
    agg = F.sum(weight_col) if weight_col else F.count(F.lit(1))
    return float(df.agg(agg).first()[0])


def fit_logistic(df: DataFrame, features: str = "features", label: str = "label", C: float = 1.0,
                 penalty: str = "l2", balanced: bool = False, max_iter: int = 100, weight_col: str | None = None,
                 fit_intercept: bool = True):
    """L1: sklearn-style logistic regression (C, l1/l2, balanced)."""
    if balanced and weight_col is None:
        counts = class_counts(df, label)
        df, weight_col = balanced_weights(df, label, counts=counts), "weight"
        sw = float(sum(counts.values()))  # balanced weights sum to n
    else:
        sw = _size_and_weight(df, weight_col)
    lr = LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter,
                            regParam=1.0 / (C * sw), elasticNetParam=1.0 if penalty == "l1" else 0.0,
                            standardization=False, fitIntercept=fit_intercept,
                            **({"weightCol": weight_col} if weight_col else {}))
    return lr.fit(df)


def fit_linear_svc(df: DataFrame, features: str = "features", label: str = "label", C: float = 1.0,
                   balanced: bool = False, max_iter: int = 100, weight_col: str | None = None):
    """L2: hinge-loss linear SVC, L2 penalty (Spark has no L1 / squared
    hinge); ``rawPrediction[1]`` is the decision value."""
    if balanced and weight_col is None:
        df, weight_col = balanced_weights(df, label), "weight"
    n = _size_and_weight(df, None)
    svc = LinearSVC(featuresCol=features, labelCol=label, maxIter=max_iter, regParam=1.0 / (C * n),
                    standardization=False, **({"weightCol": weight_col} if weight_col else {}))
    return svc.fit(df)


def fit_ridge(df: DataFrame, features: str = "features", label: str = "label", alpha: float = 1.0,
              fit_intercept: bool = True):
    """Ridge with sklearn's alpha: ``regParam = alpha * std_pop(y) / n``
    with the normal-equation solver (which standardises the label)."""
    st = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
    s = st["s"] or 1.0
    lr = LinearRegression(featuresCol=features, labelCol=label, regParam=alpha * s / st["n"], elasticNetParam=0.0,
                          standardization=False, solver="normal", fitIntercept=fit_intercept)
    return lr.fit(df)


def fit_lasso(df: DataFrame, features: str = "features", label: str = "label", alpha: float = 1.0, max_iter: int = 1000):
    """Lasso, ``regParam = alpha`` (sklearn's 1/(2n) loss scaling is
    Spark's own)."""
    lr = LinearRegression(featuresCol=features, labelCol=label, regParam=alpha, elasticNetParam=1.0,
                          standardization=False, maxIter=max_iter)
    return lr.fit(df)


class ScaledLabelModel(StateModel):
    """A fitted regressor trained on ``label / scale``; predictions are
    multiplied back (used by the elastic-net translation)."""

    def __init__(self, model=None, scale: float = 1.0, prediction: str = "prediction"):
        super().__init__(None if model is None else {"scale": scale, "prediction": prediction}, [model] if model is not None else ())

    @property
    def model(self):
        return self.parts[0]

    @property
    def scale(self) -> float:
        return self.learned["scale"]

    def _transform(self, df: DataFrame) -> DataFrame:
        out, name = self.model.transform(df), self.learned["prediction"]
        return out.withColumn(name, F.col(name) * F.lit(self.scale))

    @property
    def coefficients(self):
        return [c * self.scale for c in self.model.coefficients]

    @property
    def intercept(self):
        return self.model.intercept * self.scale


def fit_elastic_net(df: DataFrame, features: str = "features", label: str = "label", alpha: float = 1.0,
                    l1_ratio: float = 0.5, max_iter: int = 1000):
    """Sklearn ElasticNet(alpha, l1_ratio). The two penalties scale
    differently with s = std(y) inside Spark, so fit on y/s with
    regParam = a*r/s + a*(1-r) and elasticNetParam = (a*r/s) / regParam,
    then scale predictions back by s."""
    s = df.agg(F.stddev_pop(label)).first()[0] or 1.0
    l1, l2 = alpha * l1_ratio / s, alpha * (1 - l1_ratio)
    reg = l1 + l2
    scaled = df.withColumn("_ys", F.col(label) / F.lit(s))
    lr = LinearRegression(featuresCol=features, labelCol="_ys", regParam=reg, elasticNetParam=(l1 / reg) if reg else 0.0,
                          standardization=False, maxIter=max_iter)
    return ScaledLabelModel(lr.fit(scaled), s)


def poly2_features(df: DataFrame, cols, gamma: float = 1.0, coef0: float = 1.0, out: str = "features") -> DataFrame:
    """Explicit feature map of the kernel (gamma <x,z> + coef0)^2:
    gamma x_i^2, sqrt(2) gamma x_i x_j (i<j), sqrt(2 coef0 gamma) x_i, coef0.
    O(d^2) columns, linear in rows (instead of an n x n kernel matrix)."""
    cols = list(cols)
    terms = [F.lit(gamma) * F.col(c) * F.col(c) for c in cols]
    terms += [F.lit(math.sqrt(2) * gamma) * F.col(a) * F.col(b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    terms += [F.lit(math.sqrt(2 * coef0 * gamma)) * F.col(c) for c in cols]
    terms += [F.lit(float(coef0))]
    names = [f"_phi{i}" for i in range(len(terms))]
    wide = df.withColumns(dict(zip(names, terms)))
    return assemble(wide, names, out).drop(*names)


def fit_poly_ridge(df: DataFrame, cols, label: str = "label", alpha: float = 1.0, gamma: float = 1.0,
                   coef0: float = 1.0, features: str = "_poly"):
    """Kernel ridge with a degree-2 polynomial kernel, as ridge
    without intercept on the explicit feature map. Returns (model, mapper)."""
    mapped = poly2_features(df, cols, gamma, coef0, out=features)
    model = fit_ridge(mapped, features, label, alpha, fit_intercept=False)

    def mapper(frame: DataFrame) -> DataFrame:
        return poly2_features(frame, cols, gamma, coef0, out=features)

    return model, mapper


class PolyRidgeModel(StateModel):
    """Feature map and ridge in one model: maps, predicts, drops the mapped features."""

    def _transform(self, df: DataFrame) -> DataFrame:
        a = self.learned
        mapped = poly2_features(df, a["cols"], a["gamma"], a["coef0"], out=a["features"])
        return self.parts[0].transform(mapped).drop(a["features"])


class PolyRidge(FitEstimator):
    """``PolyRidge(cols=[...], label=..., alpha=1.0, gamma=1.0, coef0=1.0)`` as an ``ml`` estimator."""

    def _fit(self, df: DataFrame) -> PolyRidgeModel:
        a = {"gamma": 1.0, "coef0": 1.0, "features": "_poly", **self.options}
        model, _ = fit_poly_ridge(df, **a)
        return PolyRidgeModel({k: a[k] for k in ("cols", "gamma", "coef0", "features")}, [model])
