import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.models import blocks, linear, newton
from tessera.operators.encode import assemble


def _data(spark, n=1500, d=4, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * [1, 5, 0.2, 1] + [0, 3, 0, -1]
    y = (x @ [1.0, -0.3, 2.0, 0.0] + rng.logistic(size=n) > 0).astype(int)
    fold = rng.integers(0, 3, n)
    rows = [(int(f), *map(float, r), int(t)) for f, r, t in zip(fold, x, y)]
    df = assemble(spark.createDataFrame(rows, "fold int, a double, b double, c double, e double, label int").repartition(3), ["a", "b", "c", "e"])
    return df, x, y, fold


def _objective_gradient(x, y, w, C, cw):
    z = np.column_stack([x, np.ones(len(y))]) @ w
    p = 1 / (1 + np.exp(-z))
    s = np.where(y == 1, cw[1], cw[0])
    return np.column_stack([x, np.ones(len(y))]).T @ (s * (p - y)) * C


@pytest.mark.parametrize("penalty", ["l2", "l1"])
def test_all_folds_and_penalties_at_their_optimum(spark, penalty):
    """First-order conditions of every fit, computed from its own training rows."""
    df, x, y, fold = _data(spark)
    fits = [newton.Fit(C=c, penalty=penalty, fold=f, balanced=b) for c in (0.01, 0.1, 10.0) for f in (None, 0, 2) for b in (False, True)]
    models, jobs = newton.fit_logistic_batch(df, fits, fold_col="fold")
    assert jobs <= 15
    for f, m in zip(fits, models):
        t = np.ones(len(y), bool) if f.fold is None else fold != f.fold
        cw = [t.sum() / (2 * (y[t] == c).sum()) for c in (0, 1)] if f.balanced else (1, 1)
        w = np.append(m.coefficients.toArray(), m.intercept)
        g = _objective_gradient(x[t], y[t], w, f.C, cw)
        assert abs(g[-1]) < 1e-5
        if penalty == "l2":
            assert np.abs(g[:-1] + w[:-1]).max() < 1e-5
        else:
            on = w[:-1] != 0
            assert np.abs(g[:-1][on] + np.sign(w[:-1][on])).max(initial=0) < 1e-5 and np.abs(g[:-1][~on]).max(initial=0) <= 1 + 1e-6
    if penalty == "l1":
        assert any((m.coefficients.toArray() == 0).any() for m in models)


def test_equals_the_ml_fit(spark):
    df, *_ = _data(spark)
    for c in (0.05, 2.0):
        (m,), _ = newton.fit_logistic_batch(df, [newton.Fit(C=c, balanced=True)])
        bal = linear.balanced_weights(df, "label")
        ml = LogisticRegression(regParam=1 / (c * 1500), standardization=False, weightCol="weight", tol=1e-14, maxIter=500).fit(bal)
        assert np.allclose(m.coefficients.toArray(), ml.coefficients.toArray(), atol=1e-6) and abs(m.intercept - ml.intercept) < 1e-6
        both = m.transform(df).select("a", "b", F.col("probability").alias("p"), F.col("prediction").alias("q")).join(
            ml.transform(df).select("a", "b", "prediction", vector_to_array("probability")[1].alias("r")), ["a", "b"])
        assert both.where((F.abs(F.col("p") - F.col("r")) > 1e-6) | (F.col("q") != F.col("prediction"))).count() == 0


def test_columns_holes_separable_and_empty(spark):
    df, x, y, fold = _data(spark, 300)
    plain = df.drop("features")
    holes = plain.unionByName(spark.createDataFrame([(0, None, 1.0, 1.0, 1.0, 1), (1, 1.0, float("nan"), 1.0, 1.0, 0), (None, 1.0, 1.0, 1.0, 1.0, None)], plain.schema))
    (a,), _ = newton.fit_logistic_batch(holes, [newton.Fit(C=1.0)], ["a", "b", "c", "e"])
    (b,), _ = newton.fit_logistic_batch(df, [newton.Fit(C=1.0)])
    assert np.allclose(a.coefficients.toArray(), b.coefficients.toArray(), atol=1e-9)
    p = a.transform(plain).select("probability", "prediction").toPandas()
    z = x @ a.coefficients.toArray() + a.intercept
    assert np.allclose(np.sort(p.probability), np.sort(1 / (1 + np.exp(-z)))) and ((p.probability > 0.5) == (p.prediction == 1)).all()
    apart = df.withColumn("label", (F.col("a") > 0).cast("int"))       # separable: large C must still end
    (m,), jobs = newton.fit_logistic_batch(apart, [newton.Fit(C=1e4)])
    assert jobs <= 60 and m.coefficients[0] > 10
    with pytest.raises(ValueError):
        newton.fit_logistic_batch(df.limit(0), [newton.Fit()])


def test_block_sizes_do_not_matter(spark):
    df, *_ = _data(spark, 500)
    one = [newton.fit_blocks(blocks.pack(df, rows=r), [newton.Fit(C=1.0)])[0][0].coefficients.toArray() for r in (7, 100, 65_536)]
    assert np.allclose(one[0], one[1], atol=1e-10) and np.allclose(one[0], one[2], atol=1e-10)


def test_no_intercept_and_saved(spark, tmpdir_path):
    df, x, y, _ = _data(spark, 400)
    (m,), _ = newton.fit_logistic_batch(df, [newton.Fit(C=1.0, fit_intercept=False)])
    assert m.intercept == 0.0
    w = m.coefficients.toArray()
    assert np.abs(x.T @ (1 / (1 + np.exp(-x @ w)) - y) + w).max() < 1e-5
    m.write().save(tmpdir_path + "/m")
    assert newton.NewtonLogisticModel.load(tmpdir_path + "/m").coefficients == m.coefficients


def test_grid_search_against_single_fits(spark):
    """The batch picks what fits one by one pick, with the same scores."""
    df, x, y, fold = _data(spark, 900)
    grid = {"C": [0.003, 0.1, 5.0], "penalty": ["l2", "l1"]}
    rec, table, model = newton.logistic_grid_search(df, df, grid, metric="f1", balanced=True)
    from tessera.models.search import expand_grid
    cands, got, means = expand_grid(grid), {(r.candidate, r.fold): r for r in table.collect()}, []
    assert len(got) == len(cands) * 3
    for i, c in enumerate(cands):
        f1 = []
        for k in range(3):
            t = fold != k
            (m,), _ = newton.fit_logistic_batch(df.where(f"fold <> {k}"), [newton.Fit(balanced=True, **c)])
            p = x[~t] @ m.coefficients.toArray() + m.intercept > 0
            tp, fp, fn = (p & (y[~t] == 1)).sum(), (p & (y[~t] == 0)).sum(), (~p & (y[~t] == 1)).sum()
            f1.append(2 * tp / (2 * tp + fp + fn))
            assert abs(got[i, k].f1 - f1[-1]) < 1e-12 and abs(got[i, k].accuracy - (p == (y[~t] == 1)).mean()) < 1e-12
        means.append(np.mean(f1))
    assert rec["params"] == {k: str(v) for k, v in cands[int(np.argmax(means))].items()} and abs(rec["cv_mean"] - max(means)) < 1e-12
    assert rec["test_f1"] > 0.5 and model.learned["coefficients"]
