"""Fits of all folds at once (F10, F12, F13, F14): the same numbers as fits one by one, in a fixed number of passes."""
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.models import linear, moments, newton, search
from tessera.models.blocks import Block
from tessera.operators import encode, order, quantiles, sampling


def _rows(spark, n=400, seed=2):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 2)) * [1, 20] + [3, -5], 1)
    y = x @ [2.0, -0.1] + rng.normal(size=n)
    rows = [(i, int(i % 3), float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, fold int, a double, b double, y double").repartition(4)


def _count_jobs(spark, work):
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, group)
    try:
        out = work()
        return out, len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def _by(rows):
    return {(r.candidate, r.fold): r for r in rows}


@pytest.mark.parametrize("kind, fit, params", [("ridge", linear.fit_ridge, [{"alpha": a} for a in (0.0, 5.0, 500.0)]),
                                               ("lasso", linear.fit_lasso, [{"alpha": a} for a in (0.0005, 0.3)])])
def test_cross_validate_of_fold_fits_agrees_with_single_fits(spark, kind, fit, params):
    df = encode.assemble(_rows(spark), ["a", "b"])
    one = search.cross_validate(lambda d, **p: fit(d, label="y", **p), df, label="y", task="regression", candidates=params)
    cv = lambda c: search.cross_validate(moments.FoldFit(fit, kind, label="y"), df, label="y", task="regression", candidates=c).collect()
    many, jobs = _count_jobs(spark, lambda: cv(params))
    want, got = _by(one.collect()), _by(many)
    assert set(want) == set(got) and len(got) == 3 * len(params)
    for k, r in want.items():
        assert got[k].n == r.n and got[k].rmse == pytest.approx(r.rmse, rel=1e-4) and got[k].mae == pytest.approx(r.mae, rel=1e-3)
    assert one.schema["fold"].dataType == search.cross_validate(moments.FoldFit(fit, kind, label="y"), df, label="y", task="regression").schema["fold"].dataType
    _, more = _count_jobs(spark, lambda: cv(params * 4))
    assert more == jobs                                         # passes do not grow with the candidates


@pytest.mark.parametrize("how", ["robust", "standard"])
def test_scalers_of_all_folds_agree_with_single_fits(spark, how):
    df = _rows(spark)
    one = search.cross_validate(encode.with_scaling(lambda d: linear.fit_lasso(d, label="y", alpha=0.01), ["a", "b"], how), df, label="y", task="regression")
    fit = encode.with_scaling(moments.FoldFit(linear.fit_lasso, "lasso", label="y", alpha=0.01), ["a", "b"], how)
    got, want = _by(search.cross_validate(fit, df, label="y", task="regression").collect()), _by(one.collect())
    assert set(want) == set(got)
    for k, r in want.items():
        assert got[k].n == r.n and got[k].rmse == pytest.approx(r.rmse, rel=1e-4)


def test_incomplete_rows_are_an_error_as_in_the_fit(spark):
    df = _rows(spark).withColumn("y", F.when(F.col("id") != 7, F.col("y")))
    fit = encode.with_scaling(moments.FoldFit(linear.fit_lasso, "lasso", label="y", alpha=0.01), ["a", "b"], "robust")
    with pytest.raises(Exception, match="null or non-finite"):
        search.cross_validate(fit, df, label="y", task="regression").collect()


def test_quartiles_leaving_out_each_fold(spark):
    df = _rows(spark).withColumn("b", F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("b")))
    got = quantiles.quantiles_leaving_out(df, ["a", "b"], [0.25, 0.5, 0.75], "fold", [0, 1, 2])
    for f, r in enumerate(got):
        want = quantiles.quantiles(df.where(F.col("fold") != f), ["a", "b"], [0.25, 0.5, 0.75]).first().asDict()
        assert r == pytest.approx(want)


@pytest.mark.parametrize("hinge", [False, True])
def test_sums_by_fold_and_class_equal_plain_sums(hinge):
    """Weights, null folds (-1), a fit on all rows (-2) and class weights; many fits, so several pieces."""
    r = np.random.default_rng(3)
    n, d = 3000, 3
    b = Block(r.normal(size=(n, d)), (r.random(n) > 0.3).astype(float), r.random(n), r.integers(-1, 3, n).astype(np.int32))
    coefs, folds, cw = r.normal(size=(40, d + 1)), np.tile([-2, 0, 1, 2], 10), r.random((40, 2)) + 0.5
    got = newton._sums(b, coefs, folds, cw, hinge).reshape(40, -1)
    x, i, j = np.column_stack([b.x, np.ones(n)]), *np.triu_indices(d + 1)
    for k in range(40):
        s = np.where(b.y > 0, 1.0, -1.0)
        w = b.w * np.where(b.y > 0, cw[k, 1], cw[k, 0]) * (b.fold != folds[k])
        m = s * (x @ coefs[k])
        if hinge:
            loss, g, h = np.maximum(1 - m, 0) ** 2, -2 * np.maximum(1 - m, 0), 2.0 * (m < 1)
        else:
            p = 1 / (1 + np.exp(m))
            loss, g, h = np.logaddexp(0, -m), -p, p * (1 - p)
        want = np.concatenate([[w @ loss], (w * g * s) @ x, (w * h) @ (x[:, i] * x[:, j])])
        assert np.allclose(got[k], want, rtol=1e-10, atol=1e-10)
    assert newton.CELLS <= 65_536                               # a step's arrays stay in a core's cache


def test_coarse_then_fine_search_on_shared_blocks(spark):
    from tessera.models import blocks
    rng = np.random.default_rng(4)
    rows = [(i, float(a), int(a + rng.logistic() > 0)) for i, a in enumerate(rng.normal(size=600) * 2)]
    df = encode.assemble(sampling.assign_folds(spark.createDataFrame(rows, "id int, a double, label int"), 3, "id", "stratified", 1, label="label"), ["a"])
    packed = blocks.pack(df, fold_col="fold")
    rec, _, model = newton.logistic_grid_search(df, df, {"C": [0.01, 1.0]}, blocks=packed)
    again, _, _ = newton.logistic_grid_search(df, df, {"C": [0.01, 1.0]})
    assert hasattr(packed, "_packed")                           # the caller releases them
    blocks.release(packed)
    assert {k: v for k, v in rec.items() if k not in ("time_min", "timestamp")} == {k: v for k, v in again.items() if k not in ("time_min", "timestamp")}
    old, _, _ = search.grid_search(lambda d, C: linear.fit_logistic(d, C=C), df, df, {"C": [0.01, 1.0]})
    assert rec["cv_mean"] == pytest.approx(old["cv_mean"], abs=5e-3) and rec["test_f1"] == pytest.approx(old["test_f1"], abs=5e-3)


def test_split_counts_its_classes_once(spark):
    """Exact sizes with null classes, and keys that repeat or are null; ranks as of the whole md5 order."""
    df = spark.range(3000).select(F.when(F.col("id") % 7 > 0, (F.col("id") / 2).cast("int")).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("c"))
    s = sampling.train_test_split(df, 0.2, 5, "k", stratify="c")
    n = {(r.c, r.split): r["count"] for r in s.groupBy("c", "split").count().collect()}
    quota = {r.c: r._quota for r in sampling.class_quotas(df, "c", 0.2).collect()}
    assert sum(v for (c, t), v in n.items() if t == "test") == 600 and {c: n[c, "test"] for c in quota} == quota
    ranked = order.hash_rank(df, "k", 5, strata=["c"]).groupBy("c").agg(F.max("_rank").alias("m"), F.countDistinct("_rank").alias("d"), F.max("_n_stratum").alias("s"))
    assert all(r.m == r.d == r.s for r in ranked.collect())
