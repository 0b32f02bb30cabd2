"""Trees fitted on counted cells against the same learners on rows."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.models import cells, search, trees
from tessera.operators import encode, evaluate


def _rows(spark, n=3000, seed=3):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 20, n), rng.integers(0, 6, n), rng.integers(0, 9, n)
    y = (0.2 * a - 0.8 * b + 0.1 * a * (c > 4) + rng.normal(size=n) > 0.3).astype(int)
    t = 2.0 * a - b + rng.normal(size=n)
    rows = [(float(p), float(q), float(r), int(v), float(w), int(i % 3)) for i, (p, q, r, v, w) in enumerate(zip(a, b, c, y, t))]
    df = spark.createDataFrame(rows, "a double, b double, c double, label int, y double, fold int")
    return encode.assemble(df, ["a", "b", "c"]).repartition(3).cache()


def _values(model, df, col="prediction"):
    return [r[0] for r in model.transform(df).orderBy("a", "b", "c", "y").select(col).collect()]


def test_trees_boosting_and_adaboost_on_cells_are_those_on_rows(spark, monkeypatch):
    df = _rows(spark)
    fits = [lambda d: trees.fit_tree(d, max_depth=5, min_samples_leaf=7), lambda d: trees.fit_tree(d, max_depth=6, min_samples_split=0.05),
            lambda d: trees.fit_gbt(d, n_estimators=4, max_depth=3), lambda d: trees.fit_gbt(d, label="y", regression=True, n_estimators=4, max_depth=3),
            lambda d: trees.fit_adaboost(d, n_estimators=4), lambda d: trees.fit_adaboost_real(d, n_estimators=3, max_depth=2)]
    plain = [_values(f(df), df) for f in fits]
    monkeypatch.setattr(cells, "COMPACT_ROWS", 100)
    for i, (f, want) in enumerate(zip(fits, plain)):
        m = f(df)
        assert isinstance(m, cells.BinnedModel)
        assert np.allclose(_values(m, df), want, atol=1e-9), (i, np.flatnonzero(~np.isclose(_values(m, df), want)).size)


@pytest.mark.parametrize("regression", [False, True])
def test_forest_on_cells_draws_rows(spark, monkeypatch, regression):
    df, label = _rows(spark), "y" if regression else "label"
    whole = trees.fit_forest(df, label=label, n_estimators=8, max_depth=5, regression=regression)
    monkeypatch.setattr(cells, "COMPACT_ROWS", 100)
    m = trees.fit_forest(df, label=label, n_estimators=8, max_depth=5, regression=regression, balanced=not regression, min_samples_leaf=4)
    assert type(m.model) is type(whole) and m.model.getNumTrees == 8
    tops = [t._call_java("rootNode").impurityStats().count() for t in trees.fit_forest(df, label=label, n_estimators=8, max_depth=1, regression=regression).model.trees]
    assert len(set(tops)) > 1 and abs(np.mean(tops) - 3000) < 150         # each tree has its own draws, about as many as rows
    a, b = np.array(_values(whole, df)), np.array(_values(m, df))
    assert np.corrcoef(a, b)[0, 1] > 0.9 if regression else np.mean(a == b) > 0.93
    assert abs(m.featureImportances.toArray().sum() - 1) < 1e-9
    again = trees.fit_forest(df, label=label, n_estimators=8, max_depth=5, regression=regression, balanced=not regression, min_samples_leaf=4)
    assert np.allclose(_values(again, df), b)


def test_counted_rows_metrics_and_search(spark, monkeypatch, tmpdir_path):
    """folds, fits and metrics on cells give what the rows give; no row is lost."""
    df = _rows(spark)
    fit = lambda d, **p: trees.fit_adaboost(d, n_estimators=3, **p)
    want = {r["fold"]: r for r in search.cross_validate(fit, df, cut=False).collect()}
    assert cells.counted(df)[2] is None                                    # small: as it is
    monkeypatch.setattr(cells, "COMPACT_ROWS", 100)
    train, test, weight = cells.counted(df, df, keep=["fold"])
    assert train.agg(F.sum(weight)).first()[0] == 3000 == test.agg(F.sum(weight)).first()[0] and test.count() < 1500
    for r in search.cross_validate(fit, train, cut=False, weight=weight).collect():
        w = want[r["fold"]]
        assert (r["n"], r["tp"], r["fp"]) == (w["n"], w["tp"], w["fp"]) and abs(r["roc_auc"] - w["roc_auc"]) < 1e-9
    m = trees.fit_tree(df, max_depth=3)
    m.write().save(tmpdir_path + "/m")
    assert _values(cells.BinnedModel.load(tmpdir_path + "/m"), df) == _values(m, df)
    assert evaluate.binary_metrics(df.select("label", F.col("label").alias("prediction"), F.lit(2).alias("w")), weight="w", by=["label"]).count() == 2


def test_thresholds_are_the_learners():
    assert cells.thresholds(np.array([1.0, 3.0, 3.0, 8.0]), 32).tolist() == [2.0, 5.5]
    t = cells.thresholds(np.arange(1000.0), 32)
    assert len(t) == 31 and abs(np.diff(t).mean() - 1000 / 32) < 1


def _lineitem(spark, path, n=700):
    i = F.col("id")
    rows = spark.range(n).select((i / 4).cast("long").alias("l_orderkey"), (i % 4).cast("int").alias("l_linenumber"), (i % 37).alias("l_partkey"),
                                 (i % 11).alias("l_suppkey"), (i % 50 + 1).cast("double").alias("l_quantity"), (i % 11 / 100).alias("l_discount"),
                                 (i % 9 / 100).alias("l_tax"), (i * 7919 % 90_000 + 900).cast("double").alias("l_extendedprice"))
    rows.union(rows.where("id % 50 = 0")).drop("id").repartition(3).write.parquet(f"{path}/lineitem.parquet")   # some keys repeat


def _counting(monkeypatch):
    made, count = [], cells.count_cells
    monkeypatch.setattr(cells, "COMPACT_ROWS", 100)
    monkeypatch.setattr(cells, "count_cells", lambda *a, **k: made.append(a[2]) or count(*a, **k))
    for name, few in (("fit_gbt", 3), ("fit_forest", 3), ("fit_adaboost", 2)):
        fit = getattr(trees, name)
        monkeypatch.setattr(trees, name, lambda df, fit=fit, few=few, **k: fit(df, **{**k, "n_estimators": few}))
    return made


def test_zoo_counts_a_large_table_once(spark, monkeypatch, tmpdir_path):
    """the trees of a large table share the cells of train and test; before, each fit counted them and scored row by row."""
    import __spark_entry__ as E

    _lineitem(spark, tmpdir_path)
    made = _counting(monkeypatch)
    r = E.queries()["model_zoo_heldout"](spark, tmpdir_path).collect()
    assert [x["model"] for x in r] == ["LogisticRegression", "LinearSVC", "DecisionTree", "RandomForest", "GradientBoosting", "AdaBoost"]
    assert all(x["status"] == "ok" and x["test_accuracy"] > 0.6 for x in r) and made == ["label", "label"]


def test_regression_blend_of_a_large_table(spark, monkeypatch, tmpdir_path):
    """one count of cells serves all folds and trees; linear models and blend are those of a small table, also with repeated keys."""
    import __spark_entry__ as E

    _lineitem(spark, tmpdir_path)
    run = lambda: {x["model"]: x for x in E.queries()["regression_cv_blend"](spark, tmpdir_path).collect()}
    want = run()
    made = _counting(monkeypatch)
    got = run()
    assert made == ["y_reg"] and got.keys() == want.keys() and len(got) == 7
    for m in ("Ridge", "Lasso", "ElasticNet", "PolyKernelRidge", "Blend"):
        assert all(got[m][c] == want[m][c] or abs(got[m][c] - want[m][c]) < 2e-4 for c in ("test_rmse", "cv_rmse", "rmse_std")), (m, got[m], want[m])
    assert got["RFRegressor"]["cv_rmse"] > 0 and got["GBRegressor"]["cv_rmse"] > 0


def test_errors_on_counted_regression_rows_are_those_of_rows(spark, monkeypatch):
    """cells by fold, merged for a fit; the errors count every row."""
    df = _rows(spark)
    monkeypatch.setattr(cells, "COMPACT_ROWS", 100)
    c = cells.of(df, "features", "y", regression=True, keep=["fold"])
    fit = lambda d: trees.fit_gbt(cells.merged(d, "y"), label="y", regression=True, n_estimators=3, max_depth=3)
    got = {r["fold"]: r for r in search.cross_validate(fit, c.frame, label="y", task="regression", cut=False, weight=cells.ROWS).collect()}
    plain = lambda d: trees.fit_gbt(d, label="y", regression=True, n_estimators=3, max_depth=3)
    want = {r["fold"]: r for r in search.cross_validate(plain, df, label="y", task="regression", cut=False).collect()}
    assert got.keys() == want.keys() == {0, 1, 2}
    assert all(got[f]["n"] == want[f]["n"] and abs(got[f]["rmse"] - want[f]["rmse"]) < 1e-9 and got[f]["mae"] is None for f in got)
