"""Catalogue part 4: metrics, threshold tuning, searches over candidates,
ensembles, result summaries (V, N, S7)."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ..operators import ensemble, evaluate
from ..operators.evaluate import threshold_sweep, tune_threshold
from ..sources.io import summarise_run
from .catalog_stats import _METRICS_SQL, _SPLIT_O, _f1_sql
from .frames import (LONG_SCORES_SQL, REG_PREDS_SQL, SCORED_ORDERS_SQL, hdigit, long_scores, regression_preds,
                     round_doubles, scored_orders)
from .registry import query

_LS = f"({LONG_SCORES_SQL})"


@query("binary_metrics_by_model", f"""
WITH m AS ({_METRICS_SQL.format(where='TRUE')})
SELECT model, n, tp, fp, fn, tn, round((tp + tn) / n, 6) AS accuracy, round({_f1_sql()}, 6) AS f1,
       round(CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END, 6) AS recall FROM m""")
def binary_metrics_by_model(spark, d):
    return round_doubles(evaluate.binary_metrics(long_scores(spark, d), "label", "prediction", by=["model"]))


_AUC_SQL = f"""
WITH g AS (SELECT model, score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS q
           FROM {_LS} GROUP BY 1, 2),
c AS (SELECT *, COALESCE(sum(q) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS qb FROM g)
SELECT model, round(sum(p * (qb + q / 2.0)) / (sum(p) * sum(q)), 6) AS roc_auc FROM c GROUP BY model"""


@query("roc_auc_by_model", _AUC_SQL)
def roc_auc_by_model(spark, d):
    return round_doubles(evaluate.roc_auc(long_scores(spark, d), "label", "score", by=["model"]))


@query("pr_curve_by_model", f"""
WITH g AS (SELECT model, score AS threshold, count(*) FILTER (WHERE label = 1) AS tp, count(*) FILTER (WHERE label = 0) AS fp
           FROM {_LS} GROUP BY 1, 2),
c AS (SELECT model, threshold, sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp, sum(tp) OVER (PARTITION BY model) AS p FROM g
      WINDOW w AS (PARTITION BY model ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT model, threshold, round(ctp / (ctp + cfp), 6) AS precision, round(ctp / p, 6) AS recall FROM c""")
def pr_curve_by_model(spark, d):
    return round_doubles(evaluate.pr_curve(scored_orders(spark, d), "label", ["s_price", "s_noise", "s_mix"]))


@query("confusion_by_model", f"""
WITH g AS (SELECT model, a AS actual, p AS predicted FROM (SELECT DISTINCT model FROM {_LS})
           CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(a, p)),
c AS (SELECT model, label AS actual, prediction AS predicted, count(*) AS n FROM {_LS} GROUP BY 1, 2, 3)
SELECT g.model, g.actual, g.predicted, COALESCE(c.n, 0) AS n FROM g LEFT JOIN c
  ON g.model = c.model AND g.actual = c.actual AND g.predicted = c.predicted""")
def confusion_by_model(spark, d):
    return evaluate.confusion(long_scores(spark, d), "label", "prediction", by=["model"])


@query("classification_report_mix", f"""
WITH m AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp1,
                  count(*) FILTER (WHERE prediction = 1) AS pp1, count(*) FILTER (WHERE label = 1) AS s1,
                  count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tp0,
                  count(*) FILTER (WHERE prediction = 0) AS pp0, count(*) FILTER (WHERE label = 0) AS s0
           FROM {_LS} WHERE model = 's_mix'),
r AS (SELECT tp0 / pp0 AS p0, tp0 / s0 AS r0, tp1 / pp1 AS p1, tp1 / s1 AS r1, s0, s1, tp0, tp1 FROM m),
f AS (SELECT *, 2 * p0 * r0 / (p0 + r0) AS f0, 2 * p1 * r1 / (p1 + r1) AS f1 FROM r)
SELECT '0' AS "row", round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0 AS support FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round((tp0 + tp1) / (s0 + s1), 6), s0 + s1 FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), s0 + s1 FROM f
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 6), round((r0 * s0 + r1 * s1) / (s0 + s1), 6),
                 round((f0 * s0 + f1 * s1) / (s0 + s1), 6), s0 + s1 FROM f""")
def classification_report_mix(spark, d):
    ls = long_scores(spark, d).where(F.col("model") == "s_mix")
    return round_doubles(evaluate.classification_report(ls, "label", "prediction"))


@query("regression_metrics_by_model", f"""
SELECT model, count(*) AS n, round(avg((y - prediction) * (y - prediction)), 6) AS mse,
       round(avg(abs(y - prediction)), 6) AS mae, round(sqrt(avg((y - prediction) * (y - prediction))), 6) AS rmse,
       round(-avg((y - prediction) * (y - prediction)), 6) AS neg_mse FROM ({REG_PREDS_SQL}) GROUP BY model""")
def regression_metrics_by_model(spark, d):
    return round_doubles(evaluate.regression_metrics(regression_preds(spark, d), "y", "prediction", by=["model"]))


@query("rmsle_by_model", f"""
SELECT model, round(sqrt(avg((ln(1 + y) - ln(1 + prediction)) ** 2)), 6) AS rmse FROM ({REG_PREDS_SQL}) GROUP BY model""")
def rmsle_by_model(spark, d):
    m = evaluate.regression_metrics(regression_preds(spark, d), "y", "prediction", by=["model"], log_target=True)
    return round_doubles(m.select("model", "rmse"))


def _sweep_sql(thresholds, by="model", src=_LS):
    vals = ", ".join(f"({t}::DOUBLE)" for t in thresholds)
    return f"""SELECT {by}, t AS threshold,
  count(*) FILTER (WHERE label = 1 AND score >= t) AS tp, count(*) FILTER (WHERE label = 0 AND score >= t) AS fp,
  count(*) FILTER (WHERE label = 1 AND score < t) AS fn, count(*) FILTER (WHERE label = 0 AND score < t) AS tn
  FROM {src} CROSS JOIN (VALUES {vals}) v(t) GROUP BY {by}, t"""


_T40 = [i / 100 for i in range(30, 70)]


@query("threshold_sweep_by_model", f"""
WITH s AS ({_sweep_sql(_T40)})
SELECT model, threshold, tp, fp, fn, tn, round({_f1_sql('s')}, 6) AS f1,
       round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM s""")
def threshold_sweep_by_model(spark, d):
    return round_doubles(threshold_sweep(long_scores(spark, d), "label", "score", by=["model"]))


@query("tune_threshold_by_model", f"""
WITH s AS ({_sweep_sql(_T40)}),
f AS (SELECT model, threshold, {_f1_sql('s')} AS f1 FROM s),
b AS (SELECT model, threshold, f1 FROM f QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1 DESC, threshold) = 1)
SELECT model, CASE WHEN f1 > 0 THEN threshold ELSE 0.5 END AS threshold, round(CASE WHEN f1 > 0 THEN f1 ELSE 0.0 END, 6) AS f1
FROM b""")
def tune_threshold_by_model(spark, d):
    return round_doubles(tune_threshold(long_scores(spark, d), "label", "score", by=["model"]))


# fixed values: the coarse grid and the refinement offsets of the coarse-to-fine search
COARSE = [i / 20 for i in range(1, 20)]
FINE_OFFSETS = [i / 100 for i in range(-4, 5)]


@query("refine_threshold_grid", f"""
WITH s AS ({_sweep_sql(COARSE)}),
b AS (SELECT model, threshold AS best FROM (SELECT model, threshold, {_f1_sql('s')} AS f1 FROM s)
      QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1 DESC, threshold) = 1),
g AS (SELECT model, round(best + o, 2) AS t FROM b CROSS JOIN (VALUES {', '.join(f'({o}::DOUBLE)' for o in FINE_OFFSETS)}) v(o)),
c AS (SELECT g.model, g.t AS threshold,
        count(*) FILTER (WHERE l.label = 1 AND l.score >= g.t) AS tp, count(*) FILTER (WHERE l.label = 0 AND l.score >= g.t) AS fp,
        count(*) FILTER (WHERE l.label = 1 AND l.score < g.t) AS fn
      FROM {_LS} l JOIN g ON l.model = g.model GROUP BY 1, 2)
SELECT model, threshold, tp, fp, fn, round({_f1_sql('c')}, 6) AS f1 FROM c""")
def refine_threshold_grid(spark, d):
    ls = long_scores(spark, d)
    coarse = tune_threshold(ls, "label", "score", thresholds=COARSE, by=["model"])
    return round_doubles(evaluate.refine_thresholds(ls, coarse, FINE_OFFSETS))


# fixed values: the weight grid of the soft-vote search
WEIGHT_GRID = [[1, 1], [1, 2], [2, 1], [1, 3], [3, 1], [2, 3], [3, 2]]
VOTE_MODELS = ["s_price", "s_mix"]


def _wsql(w):
    tot = float(sum(w))
    return f"(s_price * {w[0] / tot} + s_mix * {w[1] / tot})"


@query("vote_weighted_grid", " UNION ALL ".join(
    f"""SELECT {i} AS weights_id, '{','.join(map(str, w))}' AS weights,
    round({_f1_sql('c')}, 6) AS f1, round((n - fp - fn) / n, 6) AS accuracy FROM (
      SELECT count(*) AS n, count(*) FILTER (WHERE {_wsql(w)} > 0.5 AND label = 1) AS tp,
             count(*) FILTER (WHERE {_wsql(w)} > 0.5 AND label = 0) AS fp,
             count(*) FILTER (WHERE NOT ({_wsql(w)} > 0.5) AND label = 1) AS fn FROM ({SCORED_ORDERS_SQL})) c"""
    for i, w in enumerate(WEIGHT_GRID)))
def vote_weighted_grid(spark, d):
    return round_doubles(ensemble.vote_weighted(scored_orders(spark, d), "label", VOTE_MODELS, WEIGHT_GRID))


def _candidates(seed=11, n_iter=10):
    """candidates = thresholds x weight vectors; pick n_iter by md5
    order of the candidate id (the same rule as the row samplers)."""
    grid = [(t, w) for t in (0.4, 0.45, 0.5, 0.55, 0.6) for w in WEIGHT_GRID]
    ids = [f"{t}|{w[0]},{w[1]}" for t, w in grid]
    order = sorted(range(len(grid)), key=lambda i: (hashlib.md5(f"{seed}:{ids[i]}".encode()).hexdigest(), ids[i]))
    return [(ids[i], grid[i][0], grid[i][1]) for i in order[:n_iter]]


@query("random_search_candidates", " UNION ALL ".join(
    f"""SELECT '{cid}' AS candidate, round({_f1_sql('c')}, 6) AS f1 FROM (
      SELECT count(*) FILTER (WHERE {_wsql(w)} >= {t} AND label = 1) AS tp,
             count(*) FILTER (WHERE {_wsql(w)} >= {t} AND label = 0) AS fp,
             count(*) FILTER (WHERE {_wsql(w)} < {t} AND label = 1) AS fn FROM ({SCORED_ORDERS_SQL})) c"""
    for cid, t, w in _candidates()))
def random_search_candidates(spark, d):
    s = scored_orders(spark, d)
    y = F.col("label")
    aggs = []
    cands = _candidates()
    for i, (cid, t, w) in enumerate(cands):
        p = ensemble.weighted_probability(VOTE_MODELS, w) >= t
        aggs += [F.count_if(p & (y == 1)).alias(f"tp{i}"), F.count_if(p & (y == 0)).alias(f"fp{i}"),
                 F.count_if(~p & (y == 1)).alias(f"fn{i}")]
    row = s.agg(*aggs)
    out = row.select(F.explode(F.array(*[F.struct(F.lit(cid).alias("candidate"), F.col(f"tp{i}").alias("tp"),
                                                  F.col(f"fp{i}").alias("fp"), F.col(f"fn{i}").alias("fn"))
                                         for i, (cid, _, _) in enumerate(cands)])).alias("_c")).select("_c.*")
    return round_doubles(out.select("candidate", evaluate.f1_expr().alias("f1")))


@query("vote_hard_two_models", f"""
SELECT o_orderkey, CAST(round_even((CASE WHEN s_price >= 0.5 THEN 1 ELSE 0 END + CASE WHEN s_mix >= 0.5 THEN 1 ELSE 0 END) / 2.0, 0)
                   AS INTEGER) AS prediction FROM ({SCORED_ORDERS_SQL})""")
def vote_hard_two_models(spark, d):
    ls = long_scores(spark, d).where(F.col("model").isin(VOTE_MODELS))
    return ensemble.vote_hard(ls, "o_orderkey", pred_col="prediction")


@query("vote_soft_three_models", f"""
SELECT o_orderkey, round((s_price + s_noise + s_mix) / 3, 6) AS mean_probability,
       CASE WHEN (s_price + s_noise + s_mix) / 3 > 0.5 THEN 1 ELSE 0 END AS prediction FROM ({SCORED_ORDERS_SQL})""")
def vote_soft_three_models(spark, d):
    s = scored_orders(spark, d)
    return round_doubles(ensemble.vote_soft(s, "o_orderkey", prob_cols=["s_price", "s_noise", "s_mix"]))


@query("average_regressors", f"""
SELECT o_orderkey, round(avg(prediction), 6) AS prediction FROM ({REG_PREDS_SQL}) GROUP BY o_orderkey""")
def average_regressors(spark, d):
    return round_doubles(ensemble.average_models(regression_preds(spark, d), "o_orderkey"))


def _blend_sql(k):
    return f"""
WITH r AS (SELECT model, sqrt(avg((y - prediction) * (y - prediction))) AS rmse FROM ({REG_PREDS_SQL}) GROUP BY model),
p AS (SELECT *, row_number() OVER (ORDER BY rmse, model) AS pos, count(*) OVER () AS m FROM r),
t AS (SELECT model, rmse FROM p WHERE (m >= {k} AND pos <= {k}) OR (m < {k} AND pos = 1)),
w AS (SELECT model, (1 / rmse) / sum(1 / rmse) OVER () AS weight FROM t)
SELECT o_orderkey, round(sum(prediction * weight), 6) AS prediction FROM ({REG_PREDS_SQL}) JOIN w USING (model)
GROUP BY o_orderkey"""


def _blend(spark, d, k):
    preds = regression_preds(spark, d)
    res = evaluate.regression_metrics(preds, "y", "prediction", by=["model"]).select("model", "rmse")
    return round_doubles(ensemble.blend_inverse_error(preds, res, "o_orderkey", "rmse", k=k))


query("blend_inverse_rmse_top3", _blend_sql(3))(lambda spark, d: _blend(spark, d, 3))
query("blend_inverse_rmse_fallback", _blend_sql(4))(lambda spark, d: _blend(spark, d, 4))


@query("select_top_models", f"""
WITH m AS ({_METRICS_SQL.format(where='TRUE')})
SELECT model, round({_f1_sql()}, 6) AS f1, CAST(row_number() OVER (ORDER BY {_f1_sql()} DESC, model) AS INTEGER) AS position
FROM m QUALIFY position <= 2""")
def select_top_models(spark, d):
    res = evaluate.binary_metrics(long_scores(spark, d), "label", "prediction", by=["model"]) \
        .select("model", "f1", F.lit(True).alias("has_probability"))
    return round_doubles(ensemble.select_top_models(res, "f1", 2, require="has_probability").drop("has_probability"))


@query("summarise_run", f"""
WITH m AS ({_METRICS_SQL.format(where='TRUE')}),
r AS (SELECT model, {_f1_sql()} AS f1, n / 1000.0 AS time_min FROM m)
SELECT round(sum(time_min), 6) AS total_time, count(*) AS n_results,
       (SELECT model FROM r ORDER BY f1 DESC, model LIMIT 1) AS best_model,
       round((SELECT f1 FROM r ORDER BY f1 DESC, model LIMIT 1), 6) AS best_f1 FROM r""")
def summarise_run_query(spark, d):
    res = evaluate.binary_metrics(long_scores(spark, d), "label", "prediction", by=["model"]).select(
        "model", "f1", (F.col("n") / 1000.0).alias("time_min"))
    s = summarise_run(res, "f1", "time_min")
    return round_doubles(s.select("total_time", "n_results", F.col("best.model").alias("best_model"),
                                  F.col("best.f1").alias("best_f1")))


@query("validate_submission", f"""
WITH p AS (SELECT o_orderkey FROM orders WHERE {_SPLIT_O} >= '4' AND o_orderstatus <> 'P'),
e AS (SELECT o_orderkey FROM orders WHERE {_SPLIT_O} >= '4')
SELECT (SELECT count(*) FROM p) AS n_pred, (SELECT count(*) FROM e) AS n_expected,
       (SELECT count(*) FROM e WHERE o_orderkey NOT IN (SELECT o_orderkey FROM p)) AS missing,
       (SELECT count(*) FROM p WHERE o_orderkey NOT IN (SELECT o_orderkey FROM e)) AS extra,
       (SELECT count(*) - count(DISTINCT o_orderkey) FROM p) AS duplicates,
       (SELECT count(*) FROM e WHERE o_orderkey NOT IN (SELECT o_orderkey FROM p)) = 0
       AND (SELECT count(*) FROM p WHERE o_orderkey NOT IN (SELECT o_orderkey FROM e)) = 0
       AND (SELECT count(*) - count(DISTINCT o_orderkey) FROM p) = 0 AS valid""")
def validate_submission(spark, d):
    s = scored_orders(spark, d).join(spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_orderstatus"),
                                     on="o_orderkey")
    test = s.where(hdigit("o_orderkey", "split") >= "4")
    pred = test.where(F.col("o_orderstatus") != "P").select("o_orderkey")
    return evaluate.validate_submission(pred, test.select("o_orderkey"), "o_orderkey")
