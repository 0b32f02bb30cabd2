import numpy as np
import pytest

from tessera.models import moments


def _data(spark, n=400, d=5, seed=0, holes=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * rng.uniform(0.5, 20, d) + rng.uniform(-50, 50, d)
    x[:, -1] = x[:, 0] * 0.5 + x[:, -1]
    y = x @ rng.normal(size=d) + rng.normal(size=n)
    fold = rng.integers(0, 4, n)
    rows = [(int(f), *map(float, r), float(t), 7) for f, r, t in zip(fold, x, y)]
    if holes:
        rows += [(0, None, *[1.0] * (d - 1), 1.0, 7), (1, *[1.0] * d, None, 7), (1, float("nan"), *[1.0] * d, 7), (2, *[1.0] * d, float("inf"), 7)]
    ddl = "fold int, " + ", ".join(f"`x.{i}` double" for i in range(d)) + ", y double, n int"
    return spark.createDataFrame(rows, ddl).repartition(3), x, y, fold, [f"x.{i}" for i in range(d)]


def _descent(x, y, alpha, ratio, steps=20_000):
    """Coordinate descent on rows and residuals."""
    n = len(y)
    xc, yc = x - x.mean(0), y - y.mean()
    w, r = np.zeros(x.shape[1]), yc.copy()
    for _ in range(steps):
        old = w.copy()
        for j in range(len(w)):
            r += xc[:, j] * w[j]
            rho = xc[:, j] @ r / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha * ratio, 0) / (xc[:, j] @ xc[:, j] / n + alpha * (1 - ratio))
            r -= xc[:, j] * w[j]
        if np.abs(w - old).max() < 1e-14:
            break
    return w, y.mean() - x.mean(0) @ w


@pytest.mark.parametrize("kind", ["ridge", "lasso", "elastic_net"])
def test_cross_validation_against_rows(spark, kind):
    df, x, y, fold, cols = _data(spark)
    grid = [{"alpha": a, **({"l1_ratio": 0.7} if kind == "elastic_net" else {})} for a in (0.001, 0.1, 3.0, 50.0)]
    rec, table, model = moments.linear_grid_search(df, df, cols, grid, kind=kind, label="y")
    got = {(r.candidate, r.fold): r for r in table.collect()}
    assert len(got) == 16
    mean = []
    for i, p in enumerate(grid):
        errors = []
        for f in range(4):
            t = fold != f
            xt, yt = x[t], y[t]
            if kind == "ridge":
                xc = xt - xt.mean(0)
                w = np.linalg.solve(xc.T @ xc + p["alpha"] * np.eye(5), xc.T @ (yt - yt.mean()))
                b = yt.mean() - xt.mean(0) @ w
            else:
                w, b = _descent(xt, yt, p["alpha"], p.get("l1_ratio", 1.0))
            e = y[~t] - x[~t] @ w - b
            r = got[i, f]
            assert r.n == (~t).sum() and abs(r.rmse - np.sqrt((e ** 2).mean())) < 1e-8
            assert abs(r.r2 - (1 - (e ** 2).sum() / ((y[~t] - y[~t].mean()) ** 2).sum())) < 1e-8
            errors.append(r.rmse)
        mean.append(np.mean(errors))
    assert rec["params"] == {k: str(v) for k, v in grid[int(np.argmin(mean))].items()}
    assert abs(rec["cv_mean"] - min(mean)) < 1e-12
    if kind != "ridge":
        w, b = _descent(x, y, float(rec["params"]["alpha"]), float(rec["params"].get("l1_ratio", 1.0)))
        assert np.allclose(model.coefficients, w, atol=1e-8) and abs(model.intercept - b) < 1e-7


def test_exact_zeros_and_projection(spark, tmpdir_path):
    df, x, y, _, cols = _data(spark, holes=False)
    m = moments.fit_moments(df, cols, "y", "lasso", alpha=30.0)
    assert 0.0 in m.coefficients
    m.write().save(tmpdir_path + "/m")
    back = moments.MomentsModel.load(tmpdir_path + "/m")
    p = np.array([r.prediction for r in back.transform(df).collect()])
    want = np.array([sum(r[c] * w for c, w in zip(cols, m.coefficients)) + m.intercept for r in df.collect()])
    assert np.allclose(p, want)


def test_wide_and_narrow_sums_agree(spark, monkeypatch):
    df, x, y, fold, cols = _data(spark)
    narrow = moments.fold_moments(df, cols, "y", "fold")
    monkeypatch.setattr(moments, "COLUMN_SUMS", 2)
    wide = moments.fold_moments(df, cols, "y", "fold")
    assert {str(f) for f in narrow} == set(wide)
    for f, m in narrow.items():
        o = wide[str(f)]
        assert m.n == o.n and np.allclose(m.s, o.s) and np.allclose(m.q, o.q)


def test_null_fold_trains_only_and_empty(spark):
    df, *_, cols = _data(spark)
    extra = df.limit(5).selectExpr("cast(null as int) as fold", *[f"`{c}`" for c in df.columns if c != "fold"])
    folds = moments.fold_moments(df.union(extra), cols, "y", "fold")
    rows = moments.cross_validate_moments(folds, [{"alpha": 1.0}])
    assert None in folds and [r["fold"] for r in rows] == [0, 1, 2, 3]
    one = moments.cross_validate_moments(moments.fold_moments(df.where("fold = 1"), cols, "y", "fold"), [{"alpha": 1.0}])
    assert one[0]["rmse"] is None
    assert moments.cross_validate_moments(moments.fold_moments(df.limit(0), cols, "y", "fold"), [{"alpha": 1.0}]) == []
    with pytest.raises(ValueError):
        moments.fit_moments(df.limit(0), cols, "y")
