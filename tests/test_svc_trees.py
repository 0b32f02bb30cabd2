import math

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.models import newton, trees
from tessera.models.score import score
from tessera.operators.encode import assemble


def _data(spark, n=500, seed=2, classes=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(3)
    z = x[:, 0] + 0.5 * x[:, 1] + 0.5 * rng.normal(size=n)
    y = np.digitize(z, [0.0] if classes == 2 else [-0.5, 0.6])
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return assemble(spark.createDataFrame(rows, "id long, a double, b double, c double, label int").repartition(3), ["a", "b", "c"]), x, y


@pytest.mark.parametrize("penalty", ["l1", "l2"])
def test_svc_optimality(spark, penalty):
    df, x, y = _data(spark)
    xi = np.column_stack([x, np.ones(len(y))])
    s = np.where(y == 1, 1, -1)
    fits = [newton.Fit(C=c, penalty=penalty, balanced=b, loss="squared_hinge") for c in (0.002, 0.02, 1.0) for b in (False, True)]
    models, jobs = newton.fit_logistic_batch(df, fits)
    assert jobs < 40
    for f, m in zip(fits, models):
        w = np.append(m.coefficients.toArray(), m.intercept)
        cw = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum())) if f.balanced else np.ones(len(y))
        g = -2 * f.C * xi.T @ (cw * s * np.maximum(1 - s * (xi @ w), 0))
        if penalty == "l2":
            assert np.abs(g + w).max() < 1e-4
        else:
            assert np.abs(g[w != 0] + np.sign(w[w != 0])).max(initial=0) < 1e-4 and np.abs(g[w == 0]).max(initial=0) <= 1 + 1e-4
    if penalty == "l1":
        assert (models[0].coefficients.toArray() == 0).any()
    scored = score(models[-1], df, keep=["id"]).orderBy("id").toPandas()
    assert np.allclose(scored.score, xi @ w) and (scored.prediction == (xi @ w > 0)).all()


def test_svc_grid_and_single_fit(spark, tmpdir_path):
    df, *_ = _data(spark, 300)
    folded = df.withColumn("fold", (F.col("id") % 3).cast("int"))
    rec, table, model = newton.logistic_grid_search(folded, None, {"C": [0.01, 1.0], "penalty": ["l1", "l2"]}, loss="squared_hinge", name="LinearSVC")
    assert rec["model"] == "LinearSVC" and table.count() == 12 and rec["cv_mean"] > 0.7
    one = newton.fit_svc_newton(df, C=float(rec["params"]["C"]), penalty=rec["params"]["penalty"])
    assert np.allclose(one.coefficients.toArray(), model.coefficients.toArray(), atol=1e-6)
    one.write().save(tmpdir_path + "/svc")
    assert newton.NewtonSVCModel.load(tmpdir_path + "/svc").coefficients == one.coefficients


def _tree_shape(node):
    if node.getClass().getSimpleName() == "LeafNode":
        return [(node.impurityStats().rawCount(), True)]
    return [(node.impurityStats().rawCount(), False)] + _tree_shape(node.leftChild()) + _tree_shape(node.rightChild())


def _gini_tree(x, y, rows, cuts, depth, leaf):
    """(rows, share of class 1, children) by brute force; as in the library, children that predict alike are merged."""
    n, p = len(rows), np.bincount(y[rows], minlength=2) / len(rows)
    gini = lambda r: 1 - ((np.bincount(y[r], minlength=2) / len(r)) ** 2).sum()
    best, kids = (0.0, None), None
    for f in range(x.shape[1] if depth and p.max() < 1 else 0):
        for c in cuts[f]:
            lo, hi = rows[x[rows, f] <= c], rows[x[rows, f] > c]
            if min(len(lo), len(hi)) >= leaf:
                gain = gini(rows) - len(lo) / n * gini(lo) - len(hi) / n * gini(hi)
                if gain > best[0] + 1e-12:
                    best = (gain, (lo, hi))
    if best[1] is not None:
        kids = [_gini_tree(x, y, r, cuts, depth - 1, leaf) for r in best[1]]
        if all(k[2] is None for k in kids) and (kids[0][1] > 0.5) == (kids[1][1] > 0.5):
            kids = None
    return rows, p[1], kids


def _shares(tree, least, out):
    rows, p, kids = tree
    out[rows] = p
    for k in kids if kids and len(rows) >= least else ():
        _shares(k, least, out)


@pytest.mark.parametrize("least", [2, 30, 90, 0.25, 10_000])
def test_min_samples_split_equals_brute_force(spark, tmpdir_path, least):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 8, (400, 3)).astype(float)             # few values: every cut between two of them is a candidate
    y = ((x[:, 0] + x[:, 1] * (x[:, 2] > 3) + rng.normal(size=400) * 2) > 5).astype(int)
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = assemble(spark.createDataFrame(rows, "id long, a double, b double, c double, label int"), ["a", "b", "c"])
    m = trees.fit_tree(df, max_depth=4, min_samples_leaf=3, min_samples_split=least)
    need = math.ceil(least * 400) if isinstance(least, float) else least
    inner = [n for n, leaf in _tree_shape(m._java_obj.rootNode()) if not leaf]
    assert all(n >= need for n in inner) and bool(inner) == (need <= 400)
    want = np.zeros(400)
    _shares(_gini_tree(x, y, np.arange(400), [np.arange(0.5, 8)] * 3, 4, 3), need, want)
    prob = lambda model: np.array([r.p for r in model.transform(df).select("id", vector_to_array("probability")[1].alias("p")).orderBy("id").collect()])
    assert np.allclose(prob(m), want)
    m.write().overwrite().save(tmpdir_path + "/t")
    assert np.allclose(prob(DecisionTreeClassificationModel.load(tmpdir_path + "/t")), want)


def test_min_samples_split_in_forests(spark, tmpdir_path):
    df, x, y = _data(spark)
    for regression in (False, True):
        whole = trees.fit_forest(df, n_estimators=5, max_depth=7, regression=regression)
        m = trees.fit_forest(df, n_estimators=5, max_depth=7, min_samples_split=80, regression=regression)
        assert type(m) is type(whole) and m.totalNumNodes < whole.totalNumNodes and m.getNumTrees == 5
        for t in m.trees:
            assert all(n >= 80 for n, leaf in _tree_shape(t._java_obj.rootNode()) if not leaf)
        assert m.transform(df).where("prediction is null").count() == 0
    m = trees.fit_forest(df, n_estimators=3, min_samples_split=50)
    m.write().save(tmpdir_path + "/f")
    assert RandomForestClassificationModel.load(tmpdir_path + "/f").totalNumNodes == m.totalNumNodes


@pytest.mark.parametrize("classes", [2, 3])
def test_real_adaboost_equals_numpy(spark, classes):
    df, x, y = _data(spark, 400, classes=classes)
    m = trees.fit_adaboost_real(df, n_estimators=5, max_depth=2, learning_rate=0.7, checkpoint_every=2)
    w, k, lps = np.full(len(y), 1.0), classes, []
    at = df.select("id").orderBy("id")
    assert at.count() == len(y)
    for part in m.parts:                                        # the numpy rounds, on the fitted trees' own leaves
        leaf = np.array([r.l for r in part.copy({part.leafCol: "l"}).transform(df).select("id", "l").orderBy("id").collect()])
        p = np.zeros((len(y), k))
        for v in np.unique(leaf):
            rows = leaf == v
            p[rows] = np.bincount(y[rows], w[rows], k) / w[rows].sum()
        lp = np.log(np.maximum(p, trees.EPS))
        lps.append(lp)
        code = np.where(np.arange(k)[None] == y[:, None], 1.0, -1 / (k - 1))
        w = w * np.exp(-0.7 * (k - 1) / k * (code * lp).sum(axis=1))
        w /= w.max()
    total = sum(lps)
    decision = (k - 1) * (total - total.mean(axis=1, keepdims=True))
    out = m.transform(df).orderBy("id").toPandas()
    assert (out.prediction.to_numpy() == decision.argmax(axis=1)).all()
    assert (decision.argmax(axis=1) == y).mean() > 0.7
    if k == 2:
        e = np.exp(decision / (len(m.parts)))
        assert np.allclose(out.probability, e[:, 1] / e.sum(axis=1), atol=1e-9)


def test_real_adaboost_stops_and_saves(spark, tmpdir_path):
    df, *_ = _data(spark, 200)
    easy = df.withColumn("label", (F.col("a") > 0).cast("int"))
    m = trees.AdaBoost(algorithm="SAMME.R", n_estimators=10, max_depth=3).fit(easy)
    assert 1 <= len(m.parts) < 10
    m.write().save(tmpdir_path + "/r")
    back = trees.RealAdaBoostModel.load(tmpdir_path + "/r")
    assert back.transform(easy).where("prediction <> label").count() == m.transform(easy).where("prediction <> label").count()
