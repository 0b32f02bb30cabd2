"""Catalogue part 5: models, searches, threshold tuning on model scores
(L1-L14, V8-V13, V16). Closed-form models (naive Bayes, kNN) are
oracle-checked; iterative fits are checked on rows (and by unit tests
against planted rules and closed forms)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.scalar import minmax_score
from ..models import bayes, blocks, boosting, cells, knn, linear, moments, newton, search, stacking, trees
from ..models.score import feature_importance, predict_values, score
from ..operators import encode, ensemble, evaluate, sampling
from .frames import MODEL_FEATURES, MODEL_FRAME_SQL, hdigit, hdigit_sql, model_frame, round_doubles, table
from ..session import cut_lineage, spread
from .registry import query

SEED = 42

# ------------------------------------------------------------------ L4 kNN (exact)
_EMB_SPLIT = hdigit_sql("vec_id", "knn")


@query("knn_embeddings_k_sweep", f"""
WITH tr AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE {_EMB_SPLIT} < 'c'),
te AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE {_EMB_SPLIT} >= 'c'),
d AS (SELECT te.vec_id AS q, tr.vec_id AS t, tr.label, list_distance(te.e, tr.e) AS dist FROM te CROSS JOIN tr),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY dist, t) AS rk FROM d),
v AS (SELECT q, k, label, count(*) AS votes FROM r CROSS JOIN (VALUES (1), (3), (5), (15)) ks(k) WHERE rk <= k
      GROUP BY q, k, label)
SELECT q AS vec_id, k, label AS prediction FROM v
QUALIFY row_number() OVER (PARTITION BY q, k ORDER BY votes DESC, label) = 1""")
def knn_embeddings_k_sweep(spark, d):
    emb = table(spark, d, "embeddings")
    is_train = hdigit("vec_id", "knn") < "c"
    train, test = emb.where(is_train), emb.where(~is_train)
    nb = knn.knn_neighbors(train, test, "embedding", "label", "vec_id", "vec_id", k=15)
    return knn.knn_predict(nb, "vec_id", [1, 3, 5, 15]).select("vec_id", "k", "prediction")


# ------------------------------------------------------------------ L3 naive Bayes (closed form)
def _nb_sql():
    f = MODEL_FEATURES
    stats = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in f)
    eps = "1e-9 * greatest(" + ", ".join(f"var_pop({c})" for c in f) + ")"
    terms = " + ".join(f"(-0.5 * ln(2 * pi() * (v_{c} + eps)) - ({c} - m_{c}) ** 2 / (2 * (v_{c} + eps)))" for c in f)
    return f"""
WITH m AS ({MODEL_FRAME_SQL}),
tr AS (SELECT * FROM m WHERE {hdigit_sql('rid', 'nb')} < 'c'),
te AS (SELECT * FROM m WHERE {hdigit_sql('rid', 'nb')} >= 'c'),
c AS (SELECT label, count(*) AS n, {stats} FROM tr GROUP BY label),
e AS (SELECT {eps} AS eps FROM tr),
t AS (SELECT sum(n) AS nt FROM c),
lj AS (SELECT te.rid, c.label, ln(c.n / t.nt) + {terms} AS lj FROM te CROSS JOIN c CROSS JOIN e CROSS JOIN t),
p AS (SELECT rid, max(lj) FILTER (WHERE label = 0) AS l0, max(lj) FILTER (WHERE label = 1) AS l1 FROM lj GROUP BY rid)
SELECT rid, CASE WHEN l1 > l0 THEN 1 ELSE 0 END AS prediction, round(1 / (1 + exp(l0 - l1)), 6) AS probability FROM p"""


@query("gaussian_nb_scores", _nb_sql())
def gaussian_nb_scores(spark, d):
    m = model_frame(spark, d)
    is_train = hdigit("rid", "nb") < "c"
    model = bayes.fit_gaussian_nb(m.where(is_train), MODEL_FEATURES, "label")
    return round_doubles(model.transform(m.where(~is_train)).select("rid", "prediction", "probability"))


# ------------------------------------------------------------------ shared prep
def _prepared(spark, d, folds=5, packs=False, target="label"):
    """Split 80/20 stratified on the label, standard scaling fitted on train
    only, stratified folds on train when asked, features assembled. One
    checkpoint (two with folds): what follows it is a projection with the
    scaling as literals, so the fits iterate over a short plan. ``packs``:
    the fits pack their rows themselves, no second copy is written, and the
    copies hold the features, the label and the fits' ``target`` only (beside the key that splits)."""
    m = model_frame(spark, d)
    if packs:
        m = m.select("rid", *MODEL_FEATURES, *dict.fromkeys(["label", target]))
    s = cut_lineage(sampling.train_test_split(m, 0.2, SEED, "rid", stratify="label"))
    train, test = s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "test").drop("split")
    if folds:
        train = sampling.assign_folds(train, folds, "rid", "stratified", SEED, label="label")
        train = cut_lineage(train.drop("rid") if packs else train)
    stats = encode.fit_standard(train, MODEL_FEATURES).first().asDict()  # one row
    prep = encode.ScaledModel(None, stats, MODEL_FEATURES)
    return prep.prepare(train) if packs else cut_lineage(spread(prep.prepare(train))), prep.prepare(test)


def _prepared_cells(spark, d, folds=0):
    """``_prepared`` for fits of trees alone: (train, test, weight), counted per cell if the table is large (no second copy of the rows is written)."""
    train, test = _prepared(spark, d, folds, packs=True)
    a, b, weight = cells.counted(train, test, keep=["fold"] if folds else [])
    return (a, b, weight) if weight else (cut_lineage(spread(train)), test, None)


def _prepared_rows_and_cells(spark, d):
    """``_prepared`` for a set of linear fits and trees: (train, test), (train, test, weight) of the trees. A large table is
    split in narrow copies, its cells are counted once for all trees; of a small one both are the same rows."""
    rows = table(spark, d, "lineitem").count()
    large = rows - math.ceil(0.2 * rows) > cells.COMPACT_ROWS
    train, test = _prepared(spark, d, folds=0, packs=large)
    a, b, weight = cells.counted(train, test) if large else (train, test, None)
    if large and not weight:
        train = a = cut_lineage(spread(train))
    return (train, test), (a, b, weight)


def _result_view(res):
    """The result rows; a fit that failed fails the query."""
    broken = res.where("status = 'error'").select("model", "error").first()  # one row per model
    if broken is not None:
        raise RuntimeError(f"{broken['model']}: {broken['error']}")
    return res.select("model", "status", F.to_json("params").alias("params"), F.round("cv_mean", 4).alias("cv_mean"),
                      F.round("test_accuracy", 4).alias("test_accuracy"), F.round("test_f1", 4).alias("test_f1"),
                      F.round("test_roc_auc", 4).alias("test_roc_auc"), F.round("test_rmse", 4).alias("test_rmse"))


# fixed values: the logistic-regression grid (C x penalty)
LR_GRID = {"C": [0.01, 0.1, 1.0, 10.0], "penalty": ["l2", "l1"]}


@query("logistic_grid_search")
def logistic_grid_search(spark, d):
    """V10 + V8 + L1: 8 candidates x 5 folds in one batch of Newton fits, held-out metrics of the best."""
    train, test = _prepared(spark, d, packs=True)
    rec, _, _ = newton.logistic_grid_search(train, test, LR_GRID, metric="f1", balanced=True)
    return _result_view(search.results_frame(spark, [rec]))


@query("random_search_forest")
def random_search_forest(spark, d):
    """V11 + L6: 3 random candidates of a forest grid, 3 folds."""
    train, test, weight = _prepared_cells(spark, d, folds=3)
    grid = {"n_estimators": [10, 30], "max_depth": [4, 8], "min_samples_leaf": [1, 5]}
    cands = search.random_candidates(grid, 3, SEED)

    def fit(df, **p):
        return trees.fit_forest(df, balanced=True, **p)

    rec, cv, _ = search.grid_search(fit, train, test, cands, metric="roc_auc", name="RandomForest", parallelism=4, cut=False,
                                     weight=weight)
    return _result_view(search.results_frame(spark, [rec]))


@query("coarse_to_fine_logistic")
def coarse_to_fine_logistic(spark, d):
    """A second LR grid around the best C of a first one; each grid's candidates and folds are one batch of Newton fits on the same blocks."""
    train, test = _prepared(spark, d, folds=3, packs=True)
    packed = blocks.pack(train, fold_col="fold")
    rec1, _, _ = newton.logistic_grid_search(train, None, {"C": [0.01, 1.0, 100.0]}, name="LR coarse", blocks=packed)
    best_c = float(rec1["params"]["C"])
    fine = search.refine_grid({"C": best_c}, {"C": best_c / 2}, lower={"C": 0})
    rec2, _, _ = newton.logistic_grid_search(train, test, fine, name="LR fine", blocks=packed)
    blocks.release(packed)
    return _result_view(search.results_frame(spark, [rec1, rec2]))


def _zoo():
    """Linear models, trees."""
    return {
        "LogisticRegression": lambda df: linear.fit_logistic(df, C=1.0, balanced=True),
        "LinearSVC": lambda df: linear.fit_linear_svc(df, C=1.0),
    }, {
        "DecisionTree": lambda df: trees.fit_tree(df, max_depth=6, min_samples_leaf=5),
        "RandomForest": lambda df: trees.fit_forest(df, n_estimators=50, max_depth=8),
        "GradientBoosting": lambda df: trees.fit_gbt(df, n_estimators=30, learning_rate=0.1, max_depth=4),
        "AdaBoost": lambda df: trees.fit_adaboost(df, n_estimators=20, learning_rate=1.0),
    }


@query("model_zoo_heldout")
def model_zoo_heldout(spark, d):
    """V16 over L1, L2, L5, L6, L7, L8."""
    rows, (train, test, weight) = _prepared_rows_and_cells(spark, d)
    lines, forests = _zoo()
    return _result_view(search.evaluate_models(lines, *rows, cut=False).unionByName(
        search.evaluate_models(forests, train, test, cut=False, weight=weight)))


@query("logistic_heldout")
def logistic_heldout(spark, d):
    """L1 + L13 + V1-V3: one balanced logistic regression fitted on 80% of
    the modelling table (standard-scaled on train), scored on 20%."""
    train, test = _prepared(spark, d, folds=0, packs=True)
    return _result_view(search.evaluate_models(
        {"LogisticRegression": lambda df: newton.fit_logistic_newton(df, C=1.0, balanced=True)},
        train, test, cut=False))


@query("gbt_heldout")
def gbt_heldout(spark, d):
    """L7 with the reference's boosted configuration (100 trees, depth 6,
    rate 0.1) fitted on 80% of the table, scored on 20%."""
    train, test, weight = _prepared_cells(spark, d)
    return _result_view(search.evaluate_models(
        {"GBT_100x6": lambda df: trees.fit_gbt(df, n_estimators=100, learning_rate=0.1, max_depth=6)},
        train, test, cut=False, weight=weight))


@query("leafwise_boosting_early_stop")
def leafwise_boosting_early_stop(spark, d):
    """Leaf-wise trees (15 leaves) with L1 and L2 leaf penalties and row
    sampling, stopped early on one of five folds of the training rows."""
    train, test = _prepared(spark, d, packs=True)

    def fit(df):
        return boosting.fit_boosting(df, fold_col="fold", leave_out=0, early_stopping=3, n_estimators=12, learning_rate=0.5, num_leaves=15,
                                     reg_alpha=0.1, reg_lambda=1.0, subsample=0.8, min_samples_leaf=20)
    return _result_view(search.evaluate_models({"LeafwiseBoosting": fit}, train, test, cut=False))


@query("huber_boosting_heldout")
def huber_boosting_heldout(spark, d):
    """L7 with Huber loss on the regression target."""
    train, test = _prepared(spark, d, folds=0, packs=True, target="y_reg")

    def fit(df):
        return boosting.fit_boosting(df, label="y_reg", loss="huber", n_estimators=5, learning_rate=0.5, max_depth=3, num_leaves=8)
    return _result_view(search.evaluate_models({"HuberBoosting": fit}, train, test, label="y_reg", task="regression", cut=False))


@query("tuned_thresholds")
def tuned_thresholds(spark, d):
    """V15 on real model scores: LR and GBT probabilities, and the linear
    SVC decision value min-max scaled (F9); 0.30..0.69 threshold grid."""
    train, test = _prepared(spark, d)
    tr = train.drop("fold")
    lr = linear.fit_logistic(tr, C=1.0)
    gbt = trees.fit_gbt(tr, n_estimators=30, max_depth=4)
    svc = linear.fit_linear_svc(tr, C=1.0)
    s_svc = minmax_score(score(svc, test, keep=["rid", "label"]), "score")
    scored = score(lr, test, keep=["rid", "label"]).withColumn("model", F.lit("LogisticRegression")) \
        .unionByName(score(gbt, test, keep=["rid", "label"]).withColumn("model", F.lit("GBT"))) \
        .unionByName(s_svc.withColumn("model", F.lit("LinearSVC")))
    return round_doubles(evaluate.tune_threshold(scored, "label", "score", by=["model"]))


@query("soft_vote_top_models")
def soft_vote_top_models(spark, d):
    """N6 + N2 + N3 on real scores: the two best models by held-out AUC,
    soft vote, and the weight grid scored in one pass."""
    train, test = _prepared(spark, d)
    tr = train.drop("fold")
    fits = {"LogisticRegression": linear.fit_logistic(tr, C=1.0),
            "GBT": trees.fit_gbt(tr, n_estimators=30, max_depth=4),
            "NaiveBayes": bayes.fit_gaussian_nb(tr, MODEL_FEATURES)}
    wide = test.select("rid", "label")
    for n, mdl in fits.items():
        sc = mdl.transform(test).select("rid", F.col("probability")) if n == "NaiveBayes" else \
            score(mdl, test, keep=["rid"]).select("rid", F.col("score").alias("probability"))
        wide = wide.join(sc.withColumnRenamed("probability", f"p_{n}"), on="rid")
    wide = cut_lineage(wide)
    aucs = None
    for n in fits:
        a = evaluate.roc_auc(wide.withColumn("model", F.lit(n)), "label", f"p_{n}", by=["model"])
        aucs = a if aucs is None else aucs.unionByName(a)
    top = [r["model"] for r in ensemble.select_top_models(aucs, "roc_auc", 2).collect()]  # two names
    vote = ensemble.vote_soft(wide, "rid", prob_cols=[f"p_{n}" for n in top]).join(wide.select("rid", "label"), "rid")
    m = evaluate.binary_metrics(vote.withColumn("g", F.lit("soft_vote")), "label", "prediction", by=["g"])
    grid = ensemble.vote_weighted(wide, "label", [f"p_{n}" for n in top], [[1, 1], [1, 2], [2, 1], [1, 3], [3, 1]])
    out = m.select(F.col("g").alias("weights"), "f1", "accuracy").unionByName(grid.select("weights", "f1", "accuracy"))
    return round_doubles(out)


# fixed values: the regression model set of the house-price workflow
def _reg_models():
    """Linear models, trees."""
    return {
        "Ridge": moments.FoldFit(linear.fit_ridge, "ridge", label="y_reg", alpha=10.0),
        "Lasso": moments.FoldFit(linear.fit_lasso, "lasso", label="y_reg", alpha=0.0005),
        "ElasticNet": moments.FoldFit(linear.fit_elastic_net, "elastic_net", label="y_reg", alpha=0.0005, l1_ratio=0.9),
    }, {
        "GBRegressor": lambda df: trees.fit_gbt(df, label="y_reg", regression=True, n_estimators=20, max_depth=4,
                                                learning_rate=0.1),
        "RFRegressor": lambda df: trees.fit_forest(df, label="y_reg", regression=True, n_estimators=20, max_depth=8),
    }


def _regression_rows(spark, d):
    """(train with features and folds, test with features), robust scaling (E4) fitted on the training rows only, applied to
    both; of a large table in narrow copies, split and scaled once."""
    m, stats = model_frame(spark, d), None
    rows = table(spark, d, "lineitem").count()
    large = rows - math.ceil(0.2 * rows) > cells.COMPACT_ROWS
    if large:
        m = m.select("rid", *MODEL_FEATURES, "y_reg")
    s = sampling.train_test_split(m, 0.2, SEED, "rid")
    if large:
        s = cut_lineage(s)
    raw_train, raw_test = s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "test").drop("split")
    if large:
        stats = cut_lineage(encode.fit_robust(raw_train, MODEL_FEATURES))
    train = encode.robust_scale(raw_train, MODEL_FEATURES, fit_on=raw_train, stats=stats)
    test = encode.assemble(encode.robust_scale(raw_test, MODEL_FEATURES, fit_on=raw_train, stats=stats), MODEL_FEATURES)
    if large:
        folds = cut_lineage(sampling.assign_folds(train, 5, "rid", "contiguous").drop("rid"))
        return encode.assemble(folds, MODEL_FEATURES), test
    return cut_lineage(sampling.assign_folds(encode.assemble(train, MODEL_FEATURES), 5, "rid", "contiguous")), cut_lineage(test)


@query("regression_cv_blend")
def regression_cv_blend(spark, d):
    """House-price workflow on the regression target: 5-fold unshuffled
    (contiguous) CV RMSE per model (V8 + A10), kernel ridge via the degree-2
    feature map (L12), leaderboard and inverse-RMSE blend of the top 3 (N5)
    scored on the held-out rows. Linear models take one aggregate for all
    folds; the trees of a large table share the cells of its folds."""
    train, test = _regression_rows(spark, d)
    c = cells.of(train, "features", "y_reg", regression=True, keep=["fold"])
    lines, forests = _reg_models()
    cv_rows, fitted = [], {}
    for name, fit in {**lines, **forests}.items():
        on_cells = c is not None and name in forests
        one = (lambda df, f=fit: f(cells.merged(df, "y_reg"))) if on_cells else fit
        cv = search.cross_validate(one, c.frame if on_cells else train, label="y_reg", task="regression", cut=False,
                                   parallelism=5, weight=cells.ROWS if on_cells else None)
        cv_rows.append(cv.withColumn("model", F.lit(name)))
        fitted[name] = c.model(one(c.frame)) if on_cells else fit(train.drop("fold"))
    poly_model, mapper = linear.fit_poly_ridge(train.drop("features"), MODEL_FEATURES, label="y_reg", alpha=1.0)
    allcv = cv_rows[0]
    for x in cv_rows[1:]:
        allcv = allcv.unionByName(x)
    res = cut_lineage(allcv.groupBy("model").agg(F.avg("rmse").alias("rmse"), F.stddev_pop("rmse").alias("rmse_std")))
    # each model predicts the held-out rows once, side by side
    wide = test.select("rid", "y_reg", "features", *MODEL_FEATURES)
    for name, model in fitted.items():
        wide = predict_values(model, wide, keep=wide.columns).withColumnRenamed("prediction", f"p_{name}")
    wide = predict_values(poly_model, mapper(wide.drop("features")), keep=[x for x in wide.columns if x != "features"])
    wide = cut_lineage(wide.withColumnRenamed("prediction", "p_PolyKernelRidge").drop(*MODEL_FEATURES))
    names = [*fitted, "PolyKernelRidge"]
    long = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"p_{n}").alias("prediction")) for n in names])).alias("_p")
    preds = wide.select("rid", long).select("rid", "_p.*")
    blended = ensemble.blend_inverse_error(preds, res, "rid", "rmse", k=3).withColumn("model", F.lit("Blend"))
    truth = wide.select("rid", "y_reg")
    allp = wide.drop("y_reg").join(truth, "rid").select("y_reg", long).select("y_reg", "_p.*") \
        .unionByName(blended.join(truth, "rid").select("y_reg", "model", "prediction"))
    held = evaluate.regression_metrics(allp, "y_reg", "prediction", by=["model"])
    cvres = res.select("model", F.col("rmse").alias("cv_rmse"), "rmse_std")
    return round_doubles(held.select("model", F.col("rmse").alias("test_rmse")).join(cvres, "model", "left"), 4)


@query("in_fold_scaling_lasso_cv")
def in_fold_scaling_lasso_cv(spark, d):
    """E6 + V8 + L10: robust scaling refitted inside each of 5 unshuffled
    folds together with a lasso (the scaler + model pipeline of the
    house-price script), RMSE per fold."""
    m = model_frame(spark, d).select("rid", *MODEL_FEATURES, "y_reg")
    train = cut_lineage(sampling.assign_folds(m, 5, "rid", "contiguous").drop("rid"))
    fit = encode.with_scaling(moments.FoldFit(linear.fit_lasso, "lasso", label="y_reg", alpha=0.0005), MODEL_FEATURES, "robust")
    cv = search.cross_validate(fit, train, label="y_reg", task="regression", cut=False, parallelism=5)
    return round_doubles(cv.select("fold", "n", "rmse"), 4)


@query("forest_feature_importance")
def forest_feature_importance(spark, d):
    """Forest importances, sorted, top 20 (here: all 4 features)."""
    train, _, _ = _prepared_cells(spark, d, folds=5)
    rf = trees.fit_forest(train.drop("fold"), n_estimators=30, max_depth=6)
    return round_doubles(feature_importance(rf, MODEL_FEATURES, 20, spark), 4)


@query("adaboost_cv_multi_metric")
def adaboost_cv_multi_metric(spark, d):
    """L8 inside 3-fold CV with accuracy and AUC from one aggregate (V9)."""
    train, _, weight = _prepared_cells(spark, d, folds=3)
    cv = search.cross_validate(lambda df: trees.fit_adaboost(df, n_estimators=10), train, cut=False, parallelism=3, weight=weight)
    return round_doubles(cv.select("fold", "accuracy", "f1", "roc_auc"), 4)


@query("svc_l1_grid_search")
def svc_l1_grid_search(spark, d):
    """V10 + V8 + L2: squared-hinge SVC, 6 candidates (C x penalty) x 5 folds in one batch of Newton fits."""
    train, test = _prepared(spark, d, packs=True)
    rec, _, _ = newton.logistic_grid_search(train, test, {"C": [0.001, 0.01, 1.0], "penalty": ["l1", "l2"]}, loss="squared_hinge",
                                            name="LinearSVC")
    return _result_view(search.results_frame(spark, [rec]))


@query("tree_variants_heldout")
def tree_variants_heldout(spark, d):
    """L5 and L6 with a minimum split size, L8 as SAMME.R."""
    train, test, weight = _prepared_cells(spark, d)
    return _result_view(search.evaluate_models({
        "DecisionTree": lambda df: trees.fit_tree(df, max_depth=8, min_samples_split=0.01),
        "RandomForest": lambda df: trees.fit_forest(df, n_estimators=10, max_depth=8, min_samples_split=500),
        "AdaBoostReal": lambda df: trees.fit_adaboost_real(df, n_estimators=8, n_classes=2)}, train, test, cut=False, weight=weight))


@query("calibrated_svc_table")
def calibrated_svc_table(spark, d):
    """The SVC's decision value as a probability: what it says and what happens, per tenth."""
    train, test = _prepared(spark, d, folds=3)
    model = stacking.calibrate(train, lambda df: newton.fit_svc_newton(df, C=0.01, penalty="l2"))
    return round_doubles(stacking.calibration_table(model.transform(test)), 4)
