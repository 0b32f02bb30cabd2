import json
import os

import numpy as np
import pytest
from pyspark.ml import Model
from pyspark.sql import functions as F

from tessera.models import bayes, linear, moments, newton, search, stacking
from tessera.operators import target
from tessera.operators.encode import assemble


def _data(spark, n=600, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    y = (x[:, 0] - x[:, 1] + 0.8 * rng.normal(size=n) > 0).astype(int)
    rows = [(i, *map(float, r), int(t), int(i % 4)) for i, (r, t) in enumerate(zip(x, y))]
    return assemble(spark.createDataFrame(rows, "id long, a double, b double, label int, fold int").repartition(3), ["a", "b"]), x, y


class Memory(Model):
    """Says 1 for rows it was fitted on."""

    def __init__(self, seen):
        super().__init__()
        self.seen = seen

    def _transform(self, df):
        hit = F.col("id").isin(self.seen).cast("double")
        return df.withColumn("prediction", hit).withColumn("probability", hit)


def test_no_row_is_scored_by_a_model_that_saw_it(spark):
    df, *_ = _data(spark, 80)
    df = df.unionByName(df.limit(3).withColumn("fold", F.lit(None).cast("int")).withColumn("id", F.col("id") + 1000))
    fit = lambda d: Memory([r.id for r in d.select("id").collect()])
    t = stacking.out_of_fold(df, {"m1": fit, "m2": fit}, tasks={"m2": "regression"}).toPandas()
    assert len(t) == 80 and t.id.is_unique and t.id.max() < 1000 and (t.m1 == 0).all() and (t.m2 == 0).all()


def test_stack_learns_from_out_of_fold(spark, tmpdir_path):
    df, x, y = _data(spark)
    fits = {"nb": lambda d: bayes.fit_gaussian_nb(d, ["a"]), "lr": lambda d: linear.fit_logistic(d, C=1.0)}
    m, table = stacking.fit_stack(df, fits, lambda t: newton.fit_logistic_newton(t, ["nb", "lr"], C=10.0))
    assert {"nb", "lr"} <= set(table.columns) and table.count() == 600
    one = table.where("fold = 2").select("id", "nb").orderBy("id").toPandas()
    alone = bayes.fit_gaussian_nb(df.where("fold <> 2"), ["a"]).transform(df.where("fold = 2")).orderBy("id").toPandas()
    assert np.allclose(one.nb, alone.probability)
    out = m.transform(df).orderBy("id").toPandas()
    assert (out.prediction == y).mean() > 0.75
    first = m.first_level(df).orderBy("id").toPandas()
    top = m.parts[-1]
    z = np.column_stack([first.nb, first.lr]) @ top.coefficients.toArray() + top.intercept
    assert np.allclose(out.probability, 1 / (1 + np.exp(-z)))
    m.write().save(tmpdir_path + "/stack")
    assert np.allclose(stacking.StackModel.load(tmpdir_path + "/stack").transform(df).orderBy("id").toPandas().probability, out.probability)


def platt(s, y, steps=200):
    """Newton with halving in numpy on smoothed targets."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    X, w = np.column_stack([s, np.ones(len(s))]), np.zeros(2)
    loss = lambda w: (np.logaddexp(0, X @ w) - t * (X @ w)).sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-X @ w))
        step = np.linalg.solve(X.T @ (X * (p * (1 - p))[:, None]), X.T @ (p - t))
        size = 1.0
        while loss(w - size * step) > loss(w) and size > 1e-10:
            size /= 2
        w = w - size * step
        if np.abs(step).max() < 1e-14:
            break
    return w


@pytest.mark.parametrize("scale", [1.0, 1e4])
def test_sigmoid_equals_numpy(spark, scale):
    df, x, y = _data(spark)
    s = (x[:, 0] - 0.5 * x[:, 1]) * scale + 3 * scale
    rows = [(float(a), int(b)) for a, b in zip(s, y)] + [(None, 1), (float("nan"), 0), (float("inf"), 1), (1.0, None)]
    m = stacking.fit_sigmoid(spark.createDataFrame(rows, "score double, label int"))
    w = platt(s, y)
    assert abs(m.slope - w[0]) * scale < 1e-8 and abs(m.offset - w[1]) < 1e-8 * max(1, abs(w[1]))
    with pytest.raises(ValueError):
        stacking.fit_sigmoid(df.limit(0).withColumn("score", F.col("a")))


def test_calibrated_decision_value(spark, tmpdir_path):
    """An SVC's decision value becomes a probability that matches the rates."""
    df, x, y = _data(spark, 1500)
    m = stacking.calibrate(df, lambda d: newton.fit_svc_newton(d, C=0.1, penalty="l2"))
    out = m.transform(df)
    t = stacking.calibration_table(out, bins=5).toPandas()
    assert t.n.sum() == 1500 and (np.abs(t.mean_probability - t.rate)[t.n > 100] < 0.08).all()
    m.write().save(tmpdir_path + "/c")
    assert stacking.CalibratedModel.load(tmpdir_path + "/c").transform(df).where("probability is null").count() == 0


@pytest.mark.parametrize("limits", [(10 ** 6, 1000), (0, 4)])
def test_target_encoding_against_pandas(spark, monkeypatch, limits):
    """Broadcast, and the split into hot levels and the rest."""
    monkeypatch.setattr(target, "BROADCAST_ROWS", limits[0])
    monkeypatch.setattr(target, "HOT", limits[1])
    rng = np.random.default_rng(6)
    n = 500
    level = [None if v == 7 else ("hot" if v < 4 else f"v{rng.integers(0, 60)}") for v in rng.integers(0, 12, n)]
    fold = [None if v == 3 else int(v) for v in rng.integers(0, 4, n)]
    y = [None if rng.random() < 0.05 else float(v) for v in rng.integers(0, 2, n)]
    df = spark.createDataFrame([(i, a, f, t, 1) for i, (a, f, t) in enumerate(zip(level, fold, y))], "id long, `le.vel` string, fold int, y double, _n int")
    enc = target.fit_target_encoding(df.drop("_n"), "le.vel", "y", "fold", smoothing=3.0)
    got = {r.id: r.e for r in enc.transform_train(df.drop("_n"), "e").collect()}
    plain = {r.id: r.e for r in enc.transform(df.drop("_n"), "e").collect()}
    use = [i for i in range(n) if y[i] is not None]
    for i in range(n):
        for seen, value in (([j for j in use if fold[i] is None or fold[j] != fold[i]], got[i]), (use, plain[i])):
            prior = np.mean([y[j] for j in seen])
            mine = [y[j] for j in seen if level[j] == level[i]]
            assert abs(value - (sum(mine) + 3 * prior) / (len(mine) + 3)) < 1e-12
    new = spark.createDataFrame([("never",), (None,)], "`le.vel` string")
    prior = np.mean([y[j] for j in use])
    assert abs([r.e for r in enc.transform(new, "e").collect() if r["le.vel"] == "never"][0] - prior) < 1e-12
    empty = target.fit_target_encoding(df.drop("_n").limit(0), "le.vel", "y", "fold")
    assert empty.transform(new, "e").where("e is null").count() == 2


def test_prune_correlated(spark):
    rng = np.random.default_rng(8)
    a, e = rng.normal(size=300), rng.normal(size=300)
    cols = {"a": a, "b": -a + 0.01 * e, "c": a + 0.5 * e, "d": a + 0.51 * e, "e": e, "k": np.ones(300)}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*cols.values())], ", ".join(f"{c} double" for c in cols))
    t = {r.column: r for r in target.prune_correlated(df, list(cols), 0.95).collect()}
    assert [c for c in cols if t[c].kept] == ["a", "c", "e", "k"] and t["b"].because == "a" and t["b"].r < -0.95 and t["d"].because == "c"
    assert target.drop_correlated(df.withColumn("z", F.lit(1)), list(cols)).columns == ["a", "c", "e", "k", "z"]
    back = {r.column for r in target.prune_correlated(df, list(cols)[::-1], 0.95).collect() if r.kept}
    assert back == {"k", "e", "d", "b"}


def test_killed_search_goes_on(spark, tmpdir_path):
    df, *_ = _data(spark, 300)
    grid, fitted = {"alpha": [0.1, 1.0, 100.0, 1e6]}, []

    def fit(d, alpha, stop_at=None):
        if alpha == stop_at:
            raise KeyboardInterrupt
        fitted.append(alpha)
        return moments.fit_moments(d, ["a", "b"], "label", "ridge", alpha=alpha)
    options = dict(metric="rmse", task="regression", higher_is_better=False, name="ridge")
    shown = lambda rows: [(r.candidate, r.params, round(r.mean_score, 9), round(r.std_score, 9), r.position) for r in rows]
    whole = search.resumable_search(fit, df, grid, tmpdir_path + "/log1", **options).collect()
    fitted.clear()
    with pytest.raises(KeyboardInterrupt):
        search.resumable_search(lambda d, alpha: fit(d, alpha, 100.0), df, grid, tmpdir_path + "/log2", **options)
    assert fitted == [0.1] * 4 + [1.0] * 4
    os.makedirs(f"{tmpdir_path}/log2/half", exist_ok=True)      # a folder that nobody finished
    fitted.clear()
    again = search.resumable_search(fit, df.repartition(5), grid, tmpdir_path + "/log2", **options).collect()
    assert fitted == [100.0] * 4 + [1e6] * 4 and shown(again) == shown(whole)
    fitted.clear()
    assert search.resumable_search(fit, df, grid, tmpdir_path + "/log2", **options).collect() == again and not fitted
    best = min(whole, key=lambda r: r.mean_score)
    assert best.position == 1 and json.loads(best.params)["alpha"] in (0.1, 1.0, 100.0)
    search.resumable_search(fit, df.where("id > 5"), grid, tmpdir_path + "/log2", **options)          # other rows: nothing matches
    assert len(fitted) == 16


def test_stack_writes_its_rows_once(spark, monkeypatch):
    """the out-of-fold fits and the refits read one written copy of the rows."""
    df = spark.createDataFrame([(float(i % 7), float(i % 3), int(i % 7 > 2), i % 3) for i in range(120)], "a double, b double, label int, fold int")
    written, cut = [], stacking.cut_lineage
    monkeypatch.setattr(stacking, "cut_lineage", lambda d: written.append(d.columns) or cut(d))
    stacking.fit_stack(df, {"nb": lambda d: bayes.fit_gaussian_nb(d, ["a"])}, lambda t: newton.fit_logistic_newton(t, ["nb"], C=10.0))
    assert [c for c in written if "nb" not in c] == [df.columns]
