import math

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import ensemble, evaluate, ranking, stats


def test_f1_zero_without_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    assert evaluate.f1(df).first().f1 == 0.0


def test_auc_ties_and_single_class(spark):
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)], "label int, score double")
    assert evaluate.roc_auc(tied).first().roc_auc == 0.5
    one = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, score double")
    assert evaluate.roc_auc(one).first().roc_auc is None


def test_auc_matches_mann_whitney(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) + 0.3 * y, 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    pos, neg = s[y == 1], s[y == 0]
    exp = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert math.isclose(evaluate.roc_auc(df).first().roc_auc, exp)


def test_threshold_tie_takes_lower(spark):
    # scores 0.35 and 0.36 give the same predictions for 0.31..0.35
    df = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.35)], "label int, score double")
    best = evaluate.tune_threshold(df).first()
    assert best.threshold == 0.3 and best.f1 == 1.0
    none = spark.createDataFrame([(1, 0.1), (0, 0.2)], "label int, score double")
    b2 = evaluate.tune_threshold(none).first()
    assert (b2.threshold, b2.f1) == (0.5, 0.0)


def test_confusion_full_grid_and_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "label int, prediction int")
    cm = {(r.actual, r.predicted): r.n for r in evaluate.confusion(df).collect()}
    assert cm == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 2}
    rep = {r.row: r for r in evaluate.classification_report(df).collect()}
    assert rep["1"].precision == 2 / 3 and rep["0"].f1 == 0.0 and rep["accuracy"].f1 == 2 / 3


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "label double, prediction double")
    m = evaluate.regression_metrics(df).first()
    assert m.mse == 0.5 and math.isclose(m.rmse, math.sqrt(0.5))


def test_votes(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 0, 0)], "k int, a int, b int")
    assert [r.prediction for r in ensemble.vote_hard(df, "k", ["a", "b"]).orderBy("k").collect()] == [0, 1, 0]
    p = spark.createDataFrame([(1, 0.5, 0.5), (2, 0.6, 0.5)], "k int, a double, b double")
    assert [r.prediction for r in ensemble.vote_soft(p, "k", ["a", "b"]).orderBy("k").collect()] == [0, 1]


def test_blend_weights_and_fallback(spark):
    res = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 4.0), ("d", 8.0)], "model string, rmse double")
    w = {r.model: r.weight for r in ensemble.blend_weights(res, k=3).collect()}
    assert set(w) == {"a", "b", "c"} and math.isclose(w["a"], 4 / 7)
    two = res.where(F.col("model").isin("a", "b"))
    assert {r.model: r.weight for r in ensemble.blend_weights(two, k=3).collect()} == {"a": 1.0}


def test_leaderboard_best_baseline(spark):
    res = spark.createDataFrame([("a", 0.8), ("b", 0.9), ("c", 0.9)], "model string, f1 double")
    lb = [r.model for r in ranking.leaderboard(res, "f1", k=2).orderBy("position").collect()]
    assert lb == ["b", "c"]
    assert ranking.best(res, "f1").first().model == "b"
    base = spark.createDataFrame([("a", 0.85), ("b", 0.9)], "model string, f1 double")
    cmp = {r.model: r.verdict for r in ranking.compare_to_baseline(res, base, "f1").collect()}
    assert cmp == {"a": "worse", "b": "same", "c": None}
    rk = {r.model: r["rank"] for r in ranking.rank_candidates(res.withColumnRenamed("f1", "mean_score")).collect()}
    assert rk == {"b": 1, "c": 1, "a": 3}


def test_describe_hist_box_corr(spark):
    df = spark.createDataFrame([(float(i), float(2 * i), "g" if i % 2 else "h") for i in range(1, 11)],
                               "x double, y double, g string")
    d = {r.column: r for r in stats.describe(df, ["x"]).collect()}["x"]
    assert d.median == 5.5 and d.q25 == 3.25 and math.isclose(d.std, np.std(range(1, 11), ddof=1))
    h = stats.histogram(df, "x", 3).orderBy("bin").collect()
    assert [r.n for r in h] == list(np.histogram(range(1, 11), 3)[0])
    b = stats.box_stats(df.withColumn("x", F.when(F.col("x") == 10, 100.0).otherwise(F.col("x"))), "x", []).first()
    assert b.outliers == 1 and b.whisker_high == 9.0
    c = {(r.a, r.b): r.r for r in stats.corr_matrix(df, ["x", "y"]).collect()}
    assert math.isclose(c[("x", "y")], 1.0)
