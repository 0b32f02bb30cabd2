import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.models import boosting
from tessera.models.boosting import Settings, fit_boosting
from tessera.operators.encode import assemble


def _data(spark, n=1200, d=4, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).round(3)
    z = np.sin(2 * x[:, 0]) + x[:, 1] * (x[:, 2] > 0)
    y = (z + 0.4 * rng.normal(size=n) > 0.1).astype(float)
    t = 3 * z + 0.3 * rng.normal(size=n) + np.where(rng.random(n) < 0.05, 30 * rng.normal(size=n), 0)
    fold = rng.integers(0, 4, n)
    names = [f"f{i}" for i in range(d)]
    rows = [(int(k), *map(float, r), float(a), float(b)) for k, r, a, b in zip(fold, x, y, t)]
    df = spark.createDataFrame(rows, "fold int, " + ", ".join(f"{c} double" for c in names) + ", label double, y double").repartition(3)
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0.1, 0.9, 9))) for i in range(d)]
    return assemble(df, names), x, y, t, fold, edges


def lower_quantile(v, share):
    return np.sort(v)[max(math.ceil(share * len(v) - 1e-9), 1) - 1]


def brute(x, y, edges, s: Settings):
    """Best-first boosting, row by row: [predicted margins after each tree]."""
    b = np.column_stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)])
    soft = lambda g: np.sign(g) * max(abs(g) - s.reg_alpha, 0)
    score = lambda g, h: soft(g) ** 2 / (h + s.reg_lambda) if h + s.reg_lambda > 0 else 0.0
    base = math.log((y > 0).sum() / (y <= 0).sum()) if s.loss == "logistic" else (y.mean() if s.loss == "squared" else lower_quantile(y, 0.5))
    m, out = np.full(len(y), base), []
    for _ in range(s.n_estimators):
        bend = lower_quantile(np.abs(y - m), s.huber_alpha) if s.loss == "huber" else math.inf
        if s.loss == "logistic":
            p = 1 / (1 + np.exp(-m))
            g, h = p - y, p * (1 - p)
        else:
            g, h = np.clip(m - y, -bend, bend), np.ones(len(y))

        def best(rows):
            top = (-math.inf, -1, -1)
            for f in range(x.shape[1]):
                for c in range(len(edges[f])):
                    lo = rows[b[rows, f] <= c]
                    hi = rows[b[rows, f] > c]
                    if min(len(lo), len(hi)) < max(s.min_samples_leaf, 1) or min(h[lo].sum(), h[hi].sum()) < s.min_child_weight:
                        continue
                    gain = 0.5 * (score(g[lo].sum(), h[lo].sum()) + score(g[hi].sum(), h[hi].sum()) - score(g[rows].sum(), h[rows].sum())) - s.gamma
                    if gain > top[0] + 1e-12:
                        top = (gain, f, c)
            return top
        leaves = [(np.arange(len(y)), 0, best(np.arange(len(y))))]
        while len(leaves) < s.num_leaves:
            k = max((i for i in range(len(leaves)) if s.max_depth is None or leaves[i][1] < s.max_depth), key=lambda i: (leaves[i][2][0], -i), default=None)
            if k is None or leaves[k][2][0] <= 0:
                break
            rows, depth, (_, f, c) = leaves.pop(k)
            for part in (rows[b[rows, f] <= c], rows[b[rows, f] > c]):
                leaves.append((part, depth + 1, best(part)))
        m = m.copy()
        for rows, *_ in leaves:
            if s.loss == "huber":
                r = (y - (out[-1] if out else base))[rows]
                med = lower_quantile(r, 0.5)
                m[rows] += s.learning_rate * (med + np.clip(r - med, -bend, bend).mean())
            else:
                m[rows] += -s.learning_rate * soft(g[rows].sum()) / (h[rows].sum() + s.reg_lambda)
        out.append(m)
    return out


def predictions(model, df, x):
    out = model.transform(df)
    rows = out.select("f0", "f1", "f2", "f3", "probability" if "probability" in out.columns else "prediction").collect()
    got = {tuple(r)[:4]: r[4] for r in rows}
    return np.array([got[tuple(r)] for r in x])


CASES = [dict(loss="logistic", num_leaves=8, reg_alpha=0.5, reg_lambda=1.0, min_samples_leaf=5),
         dict(loss="logistic", num_leaves=64, max_depth=3, min_samples_leaf=1, gamma=0.05),
         dict(loss="squared", num_leaves=6, min_samples_leaf=30, reg_lambda=2.0),
         dict(loss="huber", num_leaves=5, min_samples_leaf=10, huber_alpha=0.85)]


@pytest.mark.parametrize("pairs", [True, False])
@pytest.mark.parametrize("case", range(len(CASES)))
def test_equals_numpy(spark, monkeypatch, case, pairs):
    if not pairs:
        monkeypatch.setattr(boosting, "PAIR_CELLS", 0)
    monkeypatch.setattr(boosting, "CUT", 2)                    # margins written twice on the way
    df, x, y, t, _, edges = _data(spark)
    s = Settings(n_estimators=4, learning_rate=0.3, max_bins=10, **CASES[case])
    target = y if s.loss == "logistic" else t
    want = brute(x, target, edges, s)[-1]
    model = fit_boosting(df, label="label" if s.loss == "logistic" else "y", edges=edges, **vars(s))
    got = predictions(model, df, x)
    assert np.allclose(got, 1 / (1 + np.exp(-want)) if s.loss == "logistic" else want, atol=1e-9)
    trees = model.learned["trees"]
    assert model.n_trees == 4 and max((np.array(tr["feature"]) < 0).sum() for tr in trees) <= s.num_leaves
    levels = sum(max(tr["depth"], 1) for tr in trees)
    assert model.jobs <= levels + len(trees) and (not pairs or model.jobs < levels)


def test_huber_loss_falls_each_round(spark):
    df, x, y, t, _, edges = _data(spark, 600)
    s = Settings(n_estimators=6, learning_rate=0.3, loss="huber", num_leaves=6, min_samples_leaf=10)
    steps = brute(x, t, edges, s)
    model = fit_boosting(df, label="y", edges=edges, **vars(s))
    assert np.allclose(predictions(model, df, x), steps[-1], atol=1e-9)
    bend = 2.0
    loss = [np.where(np.abs(t - m) <= bend, 0.5 * (t - m) ** 2, bend * (np.abs(t - m) - bend / 2)).mean() for m in steps]
    assert all(b < a for a, b in zip(loss, loss[1:]))


def test_order_statistics_are_exact(spark):
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-300, 300, 500), [0.0, -0.0, 1e308, -1e308, 5e-324], np.full(50, 0.25)])
    df = spark.createDataFrame([(float(a), float(a), i % 3) for i, a in enumerate(v)], "x double, y double, g int").repartition(4)
    from tessera.models.blocks import pack
    state = boosting._binned(pack(df, ["x"], "y", None, "g"), [np.array([0.0])], 0.0)
    for share in (0.0, 0.1, 0.5, 0.9, 1.0):
        got, rows = boosting.order_statistics(state, lambda b: (b.y, b.fold), 4, share)  # group 3 is empty
        assert rows.tolist()[3] == 0
        for g in range(3):
            assert got[g] == lower_quantile(v[np.arange(len(v)) % 3 == g], share)


def test_early_stopping_on_a_left_out_fold(spark):
    df, x, y, _, fold, edges = _data(spark)
    model = fit_boosting(df, fold_col="fold", leave_out=1, n_estimators=60, learning_rate=0.8, num_leaves=31, min_samples_leaf=1,
                         early_stopping=4, edges=edges)
    h = model.history
    k = int(np.argmin(h))
    assert model.n_trees == k < 60 and len(h) - 1 - k <= 4
    out = fold == 1
    p = predictions(model, df, x)[out]
    assert abs(-(np.where(y[out] > 0, np.log(p), np.log(1 - p))).mean() - h[k]) < 1e-9
    assert all(np.isfinite(h))


def test_sampling_importance_saved_and_empty(spark, tmpdir_path):
    df, x, y, _, _, _ = _data(spark)
    a = fit_boosting(df, n_estimators=12, subsample=0.6, colsample=0.5, num_leaves=8, seed=3)
    b = fit_boosting(df, n_estimators=12, subsample=0.6, colsample=0.5, num_leaves=8, seed=3)
    assert a.learned["trees"] == b.learned["trees"] and a.featureImportances[0] + a.featureImportances[1] > 0.4
    assert (((predictions(a, df, x) > 0.5) == (y > 0)).mean()) > 0.8
    a.write().save(tmpdir_path + "/m")
    back = boosting.HistogramBoostingModel.load(tmpdir_path + "/m")
    assert np.allclose(predictions(back, df, x), predictions(a, df, x))
    holes = df.drop("features").limit(0)
    with pytest.raises(ValueError):
        fit_boosting(holes, ["f0", "f1"])
    one = df.where("label = 1")                                # a single class
    assert fit_boosting(one, n_estimators=3).transform(one).where("probability < 0.99").count() == 0


def test_large_sums_reach_the_driver_as_one_array(spark, monkeypatch):
    """large arrays are added slice by slice in a shuffle; what the driver collects doesn't grow with the tasks."""
    from pyspark import RDD
    from tessera.models import blocks
    df, x, *_ = _data(spark, n=400)
    packed = blocks.pack(df.repartition(6), "features", "label")
    got, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: got.append(collect(self)) or got[-1])
    size = blocks.TO_DRIVER // 4
    total = blocks.sum_arrays(packed, lambda b: np.arange(size) * float(len(b.y)), size=size)
    assert packed._tasks > 4 and np.array_equal(total, np.arange(size) * 400.0)
    assert sum(len(a) for _, a in got[0]) == size
    few = blocks.sum_arrays(packed, lambda b: b.x.sum(axis=0))
    assert np.allclose(few, x.sum(axis=0))
    blocks.release(packed)


def test_huber_query_has_its_target(spark, tmpdir_path):
    """The narrow copies of the query hold the regression target beside the label that splits them."""
    import __spark_entry__ as E

    rows = spark.range(400).select((F.col("id") / 4).cast("long").alias("l_orderkey"), (F.col("id") % 4).cast("int").alias("l_linenumber"),
                                   (F.col("id") % 37).alias("l_partkey"), (F.col("id") % 11).alias("l_suppkey"),
                                   (F.col("id") % 50 + 1).cast("double").alias("l_quantity"), (F.col("id") % 11 / 100).alias("l_discount"),
                                   (F.col("id") % 9 / 100).alias("l_tax"), (F.col("id") * 7919 % 90_000 + 900).cast("double").alias("l_extendedprice"))
    rows.write.parquet(f"{tmpdir_path}/lineitem.parquet")
    r = E.queries()["huber_boosting_heldout"](spark, tmpdir_path).collect()
    assert [x["status"] for x in r] == ["ok"] and 0 < r[0]["test_rmse"] < 2
