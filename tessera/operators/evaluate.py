"""Evaluation metrics on scored frames.

Every metric is an aggregate over (label, prediction/score) rows and takes
``by`` (model, fold, ...) so that many models / folds / thresholds are
scored in one pass. Curves (AUC, PR) first collapse rows to one per
distinct score -- a hot score value becomes one row -- and then use the
range-bucketed running sum from ``order``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .order import running_sum


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def _number(cond, weight: str | None = None):
    """Rows for which ``cond`` holds; with ``weight``, a column of row numbers, the rows they stand for."""
    return F.count_if(cond) if weight is None else F.coalesce(F.sum(F.when(cond, F.col(weight))), F.lit(0)).cast("long")


def _counts(label, pred, weight=None):
    y, p = F.col(label), F.col(pred)
    return [_number((y == 1) & (p == 1), weight).alias("tp"), _number((y == 0) & (p == 1), weight).alias("fp"),
            _number((y == 1) & (p == 0), weight).alias("fn"), _number((y == 0) & (p == 0), weight).alias("tn")]


def f1_expr(tp="tp", fp="fp", fn="fn"):
    """2tp / (2tp + fp + fn); 0 when undefined (no positives at all)."""
    den = 2 * F.col(tp) + F.col(fp) + F.col(fn)
    return F.when(den == 0, F.lit(0.0)).otherwise(2 * F.col(tp) / den)


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction", by=(), weight: str | None = None) -> DataFrame:
    """V1 + V2 (+ precision, recall) per ``by`` group in one aggregate; ``weight``: the number of rows a row stands for."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight).cast("long")
    g = df.groupBy(*_as_list(by)).agg(n.alias("n"), *_counts(label, pred, weight))
    return g.select(*_as_list(by), "n", "tp", "fp", "fn", "tn",
                    ((F.col("tp") + F.col("tn")) / F.col("n")).alias("accuracy"),
                    f1_expr().alias("f1"),
                    F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                    F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def accuracy(df: DataFrame, label="label", pred="prediction", by=()) -> DataFrame:
    """V1."""
    return df.groupBy(*_as_list(by)).agg(
        F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def f1(df: DataFrame, label="label", pred="prediction", by=()) -> DataFrame:
    """V2: F1 of the positive class (not the evaluator's weighted F1)."""
    return binary_metrics(df, label, pred, by).select(*_as_list(by), "f1")


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by=(), weight: str | None = None) -> DataFrame:
    """V3: ROC-AUC with ties counted one half (= Mann-Whitney U / (P N)).

    Per distinct score: positives p_s and negatives q_s. AUC =
    sum_s p_s * (negatives below s + q_s / 2) / (P N); NULL with one class."""
    by = _as_list(by)
    g = df.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("_s")).agg(
        _number(F.col(label) == 1, weight).alias("_p"), _number(F.col(label) == 0, weight).alias("_q"))
    c = running_sum(g, "_s", ["_q"], partition=by)
    contrib = F.col("_p") * (F.col("_q_cum") - F.col("_q") + F.col("_q") / 2.0)
    a = c.groupBy(*by).agg(F.sum(contrib).alias("_u"), F.sum("_p").alias("_P"), F.sum("_q").alias("_N"))
    return a.select(*by, F.when((F.col("_P") == 0) | (F.col("_N") == 0), F.lit(None).cast("double"))
                    .otherwise(F.col("_u") / (F.col("_P").cast("double") * F.col("_N"))).alias("roc_auc"))


def pr_curve(df: DataFrame, label: str, score_cols, model_col: str = "model") -> DataFrame:
    """V4: precision-recall points for every score column: one point per
    distinct score (threshold), thresholds descending."""
    score_cols = _as_list(score_cols)
    long = df.select(F.col(label).alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(s).alias(model_col), F.col(s).cast("double").alias("threshold")) for s in score_cols
    ])).alias("_m")).select("_y", f"_m.{model_col}", "_m.threshold").where(F.col("threshold").isNotNull())
    g = long.groupBy(model_col, "threshold").agg(F.count_if(F.col("_y") == 1).alias("_tp"),
                                                 F.count_if(F.col("_y") == 0).alias("_fp"))
    c = running_sum(g, "threshold", ["_tp", "_fp"], partition=[model_col], descending=True)
    tot = g.groupBy(model_col).agg(F.sum("_tp").alias("_P"))
    c = c.join(tot, on=model_col, how="inner")  # one row per model
    return c.select(model_col, "threshold",
                    (F.col("_tp_cum") / (F.col("_tp_cum") + F.col("_fp_cum"))).alias("precision"),
                    F.try_divide(F.col("_tp_cum").cast("double"), F.col("_P")).alias("recall"))


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction", classes=(0, 1), by=()) -> DataFrame:
    """V5: counts on the full class grid (missing cells -> 0). The grid is
    the caller's class list (k x k literal rows)."""
    by = _as_list(by)
    counts = df.groupBy(*by, F.col(label).alias("actual"), F.col(pred).alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("n"))
    cells = F.explode(F.array(*[F.struct(F.lit(a).cast("int").alias("actual"), F.lit(p).cast("int").alias("predicted"))
                                for a in classes for p in classes])).alias("_g")
    keys = counts.select(*by).distinct() if by else df.sparkSession.range(1)
    grid = keys.select(*by, cells).select(*by, "_g.actual", "_g.predicted")
    out = grid.join(counts.withColumn("actual", F.col("actual").cast("int"))
                    .withColumn("predicted", F.col("predicted").cast("int")),
                    on=[*by, "actual", "predicted"], how="left")
    return out.withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("long"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction", classes=(0, 1)) -> DataFrame:
    """V6: per class precision / recall / f1 / support, plus accuracy,
    macro avg and weighted avg rows (label column ``row``)."""
    cm = confusion(df, label, pred, classes)
    per = cm.groupBy().agg(*[x for c in classes for x in (
        F.sum(F.when((F.col("actual") == c) & (F.col("predicted") == c), F.col("n"))).alias(f"tp{c}"),
        F.sum(F.when(F.col("predicted") == c, F.col("n"))).alias(f"pp{c}"),
        F.sum(F.when(F.col("actual") == c, F.col("n"))).alias(f"sup{c}"))])
    rows = []
    for c in classes:
        p = F.coalesce(F.try_divide(F.col(f"tp{c}").cast("double"), F.col(f"pp{c}")), F.lit(0.0))
        r = F.coalesce(F.try_divide(F.col(f"tp{c}").cast("double"), F.col(f"sup{c}")), F.lit(0.0))
        f = F.when(p + r == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))
        rows.append((str(c), p, r, f, F.col(f"sup{c}")))
    total = sum((F.col(f"sup{c}") for c in classes), F.lit(0))
    acc = sum((F.col(f"tp{c}") for c in classes), F.lit(0)) / total
    k = len(classes)
    macro = [sum((x[i] for x in rows), F.lit(0.0)) / k for i in (1, 2, 3)]
    weighted = [sum((x[i] * x[4] for x in rows), F.lit(0.0)) / total for i in (1, 2, 3)]
    structs = [F.struct(F.lit(n).alias("row"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        s.cast("long").alias("support")) for n, p, r, f, s in rows]
    structs.append(F.struct(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                            F.lit(None).cast("double").alias("recall"), acc.alias("f1"),
                            total.cast("long").alias("support")))
    structs.append(F.struct(F.lit("macro avg").alias("row"), *[m.alias(n) for m, n in zip(macro, ("precision", "recall", "f1"))],
                            total.cast("long").alias("support")))
    structs.append(F.struct(F.lit("weighted avg").alias("row"), *[m.alias(n) for m, n in zip(weighted, ("precision", "recall", "f1"))],
                            total.cast("long").alias("support")))
    return per.select(F.explode(F.array(*structs)).alias("_s")).select("_s.*")


def regression_metrics(df: DataFrame, label: str = "label", pred: str = "prediction", by=(),
                       log_target: bool = False, weight: str | None = None, spread: str | None = None) -> DataFrame:
    """V7: RMSE, MSE (the negative MSE is the CV 'score'), MAE; with
    ``log_target`` on log1p of both sides (RMSLE). ``weight``: the number of rows a
    row stands for, ``label`` being their mean and ``spread`` their squared
    deviations from it; what absolute errors they have is not known (MAE is null)."""
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    if log_target:
        y, p = F.log1p(y), F.log1p(p)
    e = y - p
    if weight is None:
        g = df.groupBy(*_as_list(by)).agg(F.count(F.lit(1)).alias("n"), F.avg(e * e).alias("mse"),
                                          F.avg(F.abs(e)).alias("mae"))
    elif log_target:
        raise ValueError("logarithms of counted rows are not known")
    else:
        n = F.sum(weight)
        g = df.groupBy(*_as_list(by)).agg(n.cast("long").alias("n"), (F.sum(F.col(weight) * e * e + F.col(spread)) / n).alias("mse"),
                                          F.lit(None).cast("double").alias("mae"))
    return g.withColumn("rmse", F.sqrt("mse")).withColumn("neg_mse", -F.col("mse"))


# fixed values: the threshold grid of the tuning loop, 0.30 .. 0.69 step 0.01
THRESHOLDS = [i / 100 for i in range(30, 70)]


def threshold_sweep(df: DataFrame, label: str = "label", score: str = "score", thresholds=None,
                    by=()) -> DataFrame:
    """V15 (table): confusion counts, F1 and accuracy at every threshold in
    ONE aggregate: for each threshold t the row adds to
    ``count_if(score >= t and y = 1)`` etc. (2 x #thresholds conditional
    counts, all codegen'd), then the single row per group is unpivoted into
    one row per threshold. No join with the threshold grid."""
    by = _as_list(by)
    ts = sorted(thresholds or THRESHOLDS)
    s, y = F.col(score).cast("double"), F.col(label)
    aggs = [F.count_if(y == 1).alias("_P"), F.count_if(y == 0).alias("_N")]
    for i, t in enumerate(ts):
        aggs += [F.count_if((s >= F.lit(t)) & (y == 1)).alias(f"_tp{i}"),
                 F.count_if((s >= F.lit(t)) & (y == 0)).alias(f"_fp{i}")]
    g = df.groupBy(*by).agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_tp{i}").alias("tp"),
                                        F.col(f"_fp{i}").alias("fp")) for i, t in enumerate(ts)]))
    out = g.select(*by, "_P", "_N", rows.alias("_r")).select(
        *by, "_r.threshold", "_r.tp", "_r.fp",
        (F.col("_P") - F.col("_r.tp")).alias("fn"), (F.col("_N") - F.col("_r.fp")).alias("tn"))
    return out.select(*by, "threshold", "tp", "fp", "fn", "tn", f1_expr().alias("f1"),
                      ((F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")))
                      .alias("accuracy"))


def tune_threshold(df: DataFrame, label: str = "label", score: str = "score", thresholds=None, by=(),
                   default: float = 0.5) -> DataFrame:
    """Best threshold by F1 (first/lowest wins ties); ``default`` with
    F1 0 when no threshold gives F1 > 0 (the loop starts from best_f1 = 0)."""
    by = _as_list(by)
    sweep = threshold_sweep(df, label, score, thresholds, by)
    w = Window.partitionBy(*by).orderBy(F.col("f1").desc(), F.col("threshold"))
    top = sweep.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
    return top.select(*by, F.when(F.col("f1") > 0, F.col("threshold")).otherwise(F.lit(default)).alias("threshold"),
                      F.when(F.col("f1") > 0, F.col("f1")).otherwise(F.lit(0.0)).alias("f1"))


def refine_thresholds(df: DataFrame, best: DataFrame, offsets, label: str = "label", score: str = "score",
                      by=("model",)) -> DataFrame:
    """Evaluate best +- offsets for every group in one aggregate:
    the per-group best threshold is joined (one row per group) and each
    offset is a conditional count, so no grid rows are generated."""
    by = list(by)
    j = df.join(best.select(*by, F.col("threshold").alias("_best")), on=by)
    s, y = F.col(score), F.col(label)
    aggs = [F.count_if(y == 1).alias("_P")]
    for i, o in enumerate(offsets):
        t = F.round(F.col("_best") + F.lit(o), 2)
        aggs += [F.count_if((s >= t) & (y == 1)).alias(f"_tp{i}"), F.count_if((s >= t) & (y == 0)).alias(f"_fp{i}")]
    g = j.groupBy(*by, "_best").agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.round(F.col("_best") + F.lit(o), 2).alias("threshold"),
                                        F.col(f"_tp{i}").alias("tp"), F.col(f"_fp{i}").alias("fp"))
                               for i, o in enumerate(offsets)]))
    out = g.select(*by, "_P", rows.alias("_r")).select(*by, "_r.threshold", "_r.tp", "_r.fp",
                                                       (F.col("_P") - F.col("_r.tp")).alias("fn"))
    return out.withColumn("f1", f1_expr())


def validate_submission(pred: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Predictions keyed to the expected ids -- counts, missing and
    extra keys, duplicate keys -- from one full outer join of the two key
    count tables and one aggregate (each input is read once)."""
    pk = pred.groupBy(key).agg(F.count(F.lit(1)).alias("_cp"))
    ek = expected.groupBy(key).agg(F.count(F.lit(1)).alias("_ce"))
    j = pk.join(ek, on=key, how="full_outer")
    row = j.agg(F.coalesce(F.sum("_cp"), F.lit(0)).cast("long").alias("n_pred"),
                F.coalesce(F.sum("_ce"), F.lit(0)).cast("long").alias("n_expected"),
                F.count_if(F.col("_cp").isNull()).alias("missing"),
                F.count_if(F.col("_ce").isNull()).alias("extra"),
                F.coalesce(F.sum(F.col("_cp") - 1), F.lit(0)).cast("long").alias("duplicates"))
    return row.withColumn("valid", (F.col("missing") == 0) & (F.col("extra") == 0) & (F.col("duplicates") == 0))
