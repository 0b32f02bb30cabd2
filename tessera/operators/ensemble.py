"""Ensembles over prediction tables.

Predictions are *long* rows ``(key, model, value)`` or *wide* rows
``(key, value_model1, value_model2, ...)``. Long tables are combined with a
``groupBy(key)`` (partial aggregation); wide ones with a projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .evaluate import f1_expr


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def _mean_expr(cols):
    return reduce(lambda a, b: a + b, [F.col(c).cast("double") for c in cols]) / len(cols)


def vote_hard(df: DataFrame, key: str, pred_cols=None, model_col: str = "model", pred_col: str = "prediction",
              out: str = "prediction") -> DataFrame:
    """Mean of 0/1 predictions rounded half-to-even (a 2-2 tie -> 0)."""
    if pred_cols:
        return df.select(key, F.bround(_mean_expr(pred_cols), 0).cast("int").alias(out))
    return df.groupBy(key).agg(F.bround(F.avg(F.col(pred_col).cast("double")), 0).cast("int").alias(out))


def vote_soft(df: DataFrame, key: str, prob_cols=None, model_col: str = "model", prob_col: str = "probability",
              out: str = "prediction") -> DataFrame:
    """Mean positive-class probability; class 1 only when > 0.5 (a tie
    goes to class 0, as arg-max picks the first class)."""
    if prob_cols:
        m = _mean_expr(prob_cols)
        return df.select(key, m.alias("mean_probability"), (m > 0.5).cast("int").alias(out))
    g = df.groupBy(key).agg(F.avg(F.col(prob_col).cast("double")).alias("mean_probability"))
    return g.withColumn(out, (F.col("mean_probability") > 0.5).cast("int"))


def weighted_probability(prob_cols, weights) -> F.Column:
    tot = float(sum(weights))
    return reduce(lambda a, b: a + b, [F.col(c).cast("double") * (w / tot) for c, w in zip(prob_cols, weights)])


def vote_weighted(df: DataFrame, label: str, prob_cols, weight_grid, by=()) -> DataFrame:
    """Every weight vector of ``weight_grid`` scored in ONE aggregate:
    per vector the weighted mean probability -> class (> 0.5) -> tp/fp/fn
    counts; one output row per (by..., weights)."""
    prob_cols, by = _as_list(prob_cols), _as_list(by)
    y = F.col(label)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, w in enumerate(weight_grid):
        p = (weighted_probability(prob_cols, w) > 0.5)
        aggs += [F.count_if(p & (y == 1)).alias(f"_tp{i}"), F.count_if(p & (y == 0)).alias(f"_fp{i}"),
                 F.count_if(~p & (y == 1)).alias(f"_fn{i}")]
    g = df.groupBy(*by).agg(*aggs)
    rows = F.explode(F.array(*[F.struct(
        F.lit(i).alias("weights_id"), F.lit(",".join(str(x) for x in w)).alias("weights"),
        F.col(f"_tp{i}").alias("tp"), F.col(f"_fp{i}").alias("fp"), F.col(f"_fn{i}").alias("fn"))
        for i, w in enumerate(weight_grid)]))
    out = g.select(*by, "_n", rows.alias("_r")).select(*by, "_n", "_r.*")
    return out.select(*by, "weights_id", "weights", f1_expr().alias("f1"),
                      ((F.col("_n") - F.col("fp") - F.col("fn")) / F.col("_n")).alias("accuracy"))


def average_models(df: DataFrame, key: str, pred_cols=None, pred_col: str = "prediction",
                   out: str = "prediction") -> DataFrame:
    """Plain mean of regressors' predictions."""
    if pred_cols:
        return df.select(key, _mean_expr(pred_cols).alias(out))
    return df.groupBy(key).agg(F.avg(F.col(pred_col).cast("double")).alias(out))


def blend_weights(results: DataFrame, error: str = "rmse", k: int = 3, name: str = "model") -> DataFrame:
    """N5 weights: top-k models by error (ties by name), weight
    (1/error) / sum(1/error); with fewer than k models, the best model
    alone with weight 1. ``results`` has one row per model."""
    w = Window.orderBy(F.col(error), F.col(name))
    r = results.withColumn("_pos", F.row_number().over(w)).withColumn(
        "_m", F.count(F.lit(1)).over(Window.partitionBy()))
    top = r.where((F.col("_m") >= k) & (F.col("_pos") <= k) | (F.col("_m") < k) & (F.col("_pos") == 1))
    inv = 1.0 / F.col(error)
    return top.select(name, (inv / F.sum(inv).over(Window.partitionBy())).alias("weight"))


def blend_inverse_error(preds: DataFrame, results: DataFrame, key: str, error: str = "rmse", k: int = 3,
                        name: str = "model", pred_col: str = "prediction", out: str = "prediction") -> DataFrame:
    """Weighted sum of the chosen models' predictions per key. The
    weight table has at most k rows (broadcast is a proven bound)."""
    wts = blend_weights(results, error, k, name)
    j = preds.join(F.broadcast(wts), on=name, how="inner")
    return j.groupBy(key).agg(F.sum(F.col(pred_col) * F.col("weight")).alias(out))


def select_top_models(results: DataFrame, metric: str, k: int, descending: bool = True, name: str = "model",
                      require=None) -> DataFrame:
    """The k best models for an ensemble. ``require`` (a boolean column
    name, e.g. ``has_probability``) excludes models that cannot enter a soft
    vote."""
    r = results.where(F.col(require)) if require else results
    m = F.col(metric).desc() if descending else F.col(metric).asc()
    return r.withColumn("position", F.row_number().over(Window.orderBy(m, F.col(name)))) \
        .where(F.col("position") <= k)
