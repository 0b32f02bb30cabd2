import math
import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tessera.models import bayes, knn, linear, search, trees
from tessera.models.score import feature_importance, score
from tessera.operators import encode
from tessera.sources import io


def _planted(spark, n=2000, seed=0):
    rng = np.random.default_rng(seed)
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = (2 * x1 - x2 + 0.3 * rng.normal(size=n) > 0).astype(int)
    rows = [(i, float(a), float(b), int(c), float(3 * a - 2 * b + 0.1 * rng.normal())) for i, (a, b, c) in
            enumerate(zip(x1, x2, y))]
    df = spark.createDataFrame(rows, "id long, x1 double, x2 double, label int, yr double")
    return encode.assemble(df, ["x1", "x2"])


def test_logistic_recovers_planted_rule(spark):
    df = _planted(spark)
    m = linear.fit_logistic(df, C=10.0)
    w = m.coefficients.toArray()
    assert w[0] > 0 > w[1]
    acc = score(m, df, keep=["label"]).select(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert acc > 0.9


def test_ridge_matches_closed_form(spark):
    df = _planted(spark, 500)
    pdf = df.select("x1", "x2", "yr").toPandas()
    X = np.c_[pdf.x1, pdf.x2]
    Xc, yc = X - X.mean(0), pdf.yr - pdf.yr.mean()
    alpha = 5.0
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(2), Xc.T @ yc)
    m = linear.fit_ridge(df, label="yr", alpha=alpha)
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-4)


def test_gaussian_nb_matches_manual(spark):
    df = _planted(spark, 300)
    m = bayes.fit_gaussian_nb(df, ["x1", "x2"])
    pdf = df.select("x1", "x2", "label").toPandas()
    out = m.transform(df).toPandas()
    eps = 1e-9 * max(pdf.x1.var(ddof=0), pdf.x2.var(ddof=0))
    lj = []
    for c in (0, 1):
        g = pdf[pdf.label == c]
        ll = math.log(len(g) / len(pdf))
        for f in ("x1", "x2"):
            v = g[f].var(ddof=0) + eps
            ll = ll - 0.5 * np.log(2 * np.pi * v) - (pdf[f] - g[f].mean()) ** 2 / (2 * v)
        lj.append(ll)
    exp = (lj[1] > lj[0]).astype(int)
    assert (out.prediction.to_numpy() == exp.to_numpy()).all()


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(120, 3))
    y = (X[:, 0] > 0).astype(int)
    rows = [(i, X[i].tolist(), int(y[i])) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int")
    train, test = df.where("id < 90"), df.where("id >= 90")
    nb = knn.knn_neighbors(train, test, "v", "label", "id", "id", k=5, rows_per_block=25)  # several blocks
    got = knn.knn_predict(nb, "id", [1, 5]).toPandas()
    d = np.sqrt(((X[90:, None, :] - X[None, :90, :]) ** 2).sum(-1))
    for kk in (1, 5):
        idx = np.argsort(d, axis=1, kind="stable")[:, :kk]
        exp = (y[:90][idx].mean(1) > 0.5).astype(int)
        g = got[got.k == kk].sort_values("id")
        assert (g.prediction.to_numpy() == exp).all()


def test_poly_feature_map_is_kernel(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.5, -1.0)], "a double, b double")
    out = linear.poly2_features(df, ["a", "b"], gamma=0.5, coef0=1.0).collect()
    u, v = out[0].features.toArray(), out[1].features.toArray()
    assert math.isclose(u @ v, (0.5 * (1.0 * 0.5 + 2.0 * -1.0) + 1.0) ** 2)


def test_adaboost_and_trees_beat_chance(spark):
    df = _planted(spark, 800)
    ada = trees.fit_adaboost(df, n_estimators=8)
    acc = score(ada, df, keep=["label"]).select(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert acc > 0.75
    rf = trees.fit_forest(df, n_estimators=10, max_depth=4)
    imp = feature_importance(rf, ["x1", "x2"], spark=spark).collect()
    assert imp[0].feature == "x1"


def test_grid_search_and_candidates(spark):
    from tessera.operators.sampling import assign_folds
    df = assign_folds(_planted(spark, 600), 3, "id", "stratified", 1, label="label")
    rec, cv, _ = search.grid_search(lambda d, C: linear.fit_logistic(d, C=C), df, df, {"C": [0.01, 1.0]})
    assert rec["status"] == "ok" and cv.count() == 2 and rec["test_f1"] > 0.8
    c = search.random_candidates({"a": [1, 2, 3], "b": ["x", "y"]}, 4, 9)
    assert len(c) == 4 and c == search.random_candidates({"a": [1, 2, 3], "b": ["x", "y"]}, 4, 9)
    assert search.refine_grid({"C": 1.0}, {"C": 0.5}) == {"C": [0.5, 1.0, 1.5]}


def test_evaluate_models_records_errors(spark):
    df = _planted(spark, 300)

    def boom(d):
        raise ImportError("missing")

    res = {r.model: r.status for r in search.evaluate_models({"lr": lambda d: linear.fit_logistic(d), "x": boom},
                                                                df, df).collect()}
    assert res == {"lr": "ok", "x": "error"}


def test_csv_roundtrip_and_repair(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "t.csv")
    with open(p, "w") as f:
        f.write('PassengerId,Name,Age\n1,"Kelly, Mr. James",34.5\n2,"O""Brien, Mrs. A",\n')
    df = io.read_csv(spark, p, schema="PassengerId long, Name string, Age double")
    rows = df.orderBy("PassengerId").collect()
    assert rows[0].Name == "Kelly, Mr. James" and rows[1].Name == 'O"Brien, Mrs. A' and rows[1].Age is None
    lines = spark.createDataFrame([("id,a,label",), ("1,5,Absence2,6,Presence3,7,Absence",), ("",)], "value string")
    rep = io.repair_records(lines, "id long, a int, label string").orderBy("id").collect()
    assert [(r.id, r.a, r.label) for r in rep] == [(1, 5, "Absence"), (2, 6, "Presence"), (3, 7, "Absence")]


def test_result_log_and_model_persistence(spark, tmpdir_path):
    res = spark.createDataFrame([("Random Forest/v1", 0.8, 1.0), ("LR", 0.9, 2.0)], "model string, f1 double, time_min double")
    path = os.path.join(tmpdir_path, "log")
    io.append_results(res, path)
    io.append_results(res, path)
    back = io.read_results(spark, path)
    assert back.count() == 4 and "model_file" in back.columns
    assert io.read_results(spark, os.path.join(tmpdir_path, "missing")).count() == 0
    s = io.summarise_run(res, "f1").first()
    assert s.n_results == 2 and s.best.model == "LR" and s.total_time == 3.0
    m = linear.fit_logistic(_planted(spark, 200))
    mp = os.path.join(tmpdir_path, "model")
    io.save_model(m, mp)
    assert io.load_model(mp).coefficients == m.coefficients
    io.write_submission(res, os.path.join(tmpdir_path, "sub"), ["model", "f1"], single_file=True)
    assert len([f for f in os.listdir(os.path.join(tmpdir_path, "sub")) if f.endswith(".csv")]) == 1


def test_entry_smoke(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    assert out.count() > 0 and out.columns == ["price_bin", "n", "rate", "ci_low", "ci_high"]
    assert set(E.oracle_sql()) <= set(E.queries())


def test_in_fold_scaling_and_json_results(spark, tmpdir_path):
    from tessera.operators.sampling import assign_folds
    df = assign_folds(_planted(spark, 400).drop("features"), 4, "id", "shuffled", 3)
    fit = encode.with_scaling(lambda d: linear.fit_ridge(d, label="yr", alpha=1.0), ["x1", "x2"], "robust")
    cv = search.cross_validate(fit, df, label="yr", task="regression")
    assert cv.count() == 4 and all(r.rmse < 0.5 for r in cv.collect())
    path = os.path.join(tmpdir_path, "results")
    res = search.results_frame(spark, [{"model": "m", "params": {"C": "1"}, "status": "ok", "test_f1": 0.5}])
    io.write_results(res, path)
    back = spark.read.json(path).first()
    assert back.model == "m" and back.params.C == "1" and back.test_f1 == 0.5


def test_csv_na_nulls_and_spaced_names(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "h.csv")
    with open(p, "w") as f:
        f.write("Id,Alley,Heart Disease\n1,NA,Presence\n2,Grvl,Absence\n")
    df = io.normalise_names(io.read_csv(spark, p, schema="Id long, Alley string, `Heart Disease` string",
                                        null_value="NA"))
    assert df.columns == ["Id", "Alley", "Heart_Disease"]
    rows = df.orderBy("Id").collect()
    assert rows[0].Alley is None and rows[1].Alley == "Grvl"


def test_city_block_blocks_agree_with_brute_force_and_stay_small(spark):
    """single-precision tiles rank, doubles decide (ties by key); a block is far below a task's memory."""
    rng = np.random.default_rng(5)
    t, q = np.round(rng.normal(size=(5000, 9)), 2), np.round(rng.normal(size=(40, 9)), 2)
    t[100:140] = t[0]                                          # copies: ties at any rank
    q[0] = t[0]
    tp = pd.DataFrame({"_tk": [f"v{i}" for i in range(len(t))], "_ty": 0.0, "_tx": list(t)})
    got = knn._local_topk(7, "manhattan", 2.0)(pd.DataFrame({"_qk": range(len(q)), "_qx": list(q)}), tp)
    for i in range(len(q)):
        dist = np.abs(q[i] - t).sum(-1)
        want = sorted((d, f"v{j}") for j, d in enumerate(dist))[:7]
        mine = got[got._qk == i]
        assert mine._tk.tolist() == [k for _, k in want] and np.allclose(mine._dist, [d for d, _ in want], atol=1e-12)
    approx = knn._city_block(q, knn._tiles(t))
    assert np.abs(approx - np.abs(q[:, None] - t[None]).sum(-1)).max() < 1e-4
    assert knn.BLOCK_BYTES <= 32 << 20 and 8 * knn.CHUNK_CELLS <= 16 << 20
