"""Catalogue part 3: descriptive statistics and ranking (A, W)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ranking, sampling, stats
from ..operators.evaluate import binary_metrics, roc_auc
from .frames import (LONG_SCORES_SQL, NULLED_LINEITEM_SQL, hdigit, hdigit_sql, long_scores, nulled_lineitem,
                     round_doubles, table)
from .registry import query

_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("describe_lineitem", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        round(min({c})::DOUBLE, 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
        round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q75,
        round(max({c})::DOUBLE, 6) AS max, round(stddev_pop({c}), 6) AS std_pop FROM lineitem""" for c in _DESC_COLS))
def describe_lineitem(spark, d):
    return round_doubles(stats.describe(table(spark, d, "lineitem"), _DESC_COLS))


@query("count_by_status_priority", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2""")
def count_by_status_priority(spark, d):
    return stats.count_by(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("rate_by_linestatus", """
SELECT l_linestatus, count(*) AS n, round(avg(y), 6) AS rate,
  round(greatest(avg(y) - 1.96 * sqrt(avg(y) * (1 - avg(y)) / count(*)), 0.0), 6) AS ci_low,
  round(least(avg(y) + 1.96 * sqrt(avg(y) * (1 - avg(y)) / count(*)), 1.0), 6) AS ci_high
FROM (SELECT l_linestatus, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem) GROUP BY 1""")
def rate_by_linestatus(spark, d):
    li = table(spark, d, "lineitem").select("l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return round_doubles(stats.rate_by(li, "l_linestatus", "y"))


def _hist_sql(col, src, bins, by):
    return f"""WITH r AS (SELECT min({col})::DOUBLE AS lo, max({col})::DOUBLE AS hi FROM {src}),
b AS (SELECT {by}, CAST(CASE WHEN (hi - lo) / {bins} = 0 THEN 0
                ELSE least({bins - 1}, floor(({col} - lo) / ((hi - lo) / {bins}))) END AS INTEGER) AS bin,
             lo, (hi - lo) / {bins} AS w FROM {src} CROSS JOIN r)"""


@query("histogram_price_by_status", _hist_sql("o_totalprice", "orders", 30, "o_orderstatus") + """
SELECT o_orderstatus, bin, count(*) AS n, round(any_value(lo + bin * w), 6) AS lower,
       round(any_value(lo + (bin + 1) * w), 6) AS upper FROM b GROUP BY 1, 2""")
def histogram_price_by_status(spark, d):
    return round_doubles(stats.histogram(table(spark, d, "orders"), "o_totalprice", 30, by=["o_orderstatus"]))


@query("density_price_by_status", _hist_sql("o_totalprice", "orders", 20, "o_orderstatus") + """,
h AS (SELECT o_orderstatus, bin, count(*) AS n, any_value(lo + bin * w) AS lower,
             any_value(lo + (bin + 1) * w) AS upper FROM b GROUP BY 1, 2)
SELECT o_orderstatus, bin, n, round(lower, 6) AS lower, round(upper, 6) AS upper,
       round(n / (sum(n) OVER (PARTITION BY o_orderstatus) * (upper - lower)), 12) AS density FROM h""")
def density_price_by_status(spark, d):
    out = stats.density(table(spark, d, "orders"), "o_totalprice", ["o_orderstatus"], bins=20)
    return round_doubles(out.withColumn("density", F.round("density", 12)))


@query("box_stats_price", """
WITH q AS (SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice, 0.25) AS q1,
                  quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3
           FROM lineitem GROUP BY 1, 2),
j AS (SELECT l.l_returnflag, l.l_linestatus, l.l_extendedprice AS x, q1, median, q3,
             l.l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM lineitem l JOIN q ON l.l_returnflag = q.l_returnflag AND l.l_linestatus = q.l_linestatus)
SELECT l_returnflag, l_linestatus, count(*) AS n, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
       round(any_value(q3), 6) AS q3, round(min(x) FILTER (WHERE inside), 6) AS whisker_low,
       round(max(x) FILTER (WHERE inside), 6) AS whisker_high, count(*) FILTER (WHERE NOT inside) AS outliers
FROM j GROUP BY 1, 2""")
def box_stats_price(spark, d):
    return round_doubles(stats.box_stats(table(spark, d, "lineitem"), "l_extendedprice",
                                         ["l_returnflag", "l_linestatus"]))


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("corr_matrix_lineitem", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM ({NULLED_LINEITEM_SQL})"
    for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i:]))
def corr_matrix_lineitem(spark, d):
    return round_doubles(stats.corr_matrix(nulled_lineitem(spark, d), _CORR_COLS))


_TC_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query("top_correlated_price", "SELECT \"column\", round(r, 6) AS r FROM (SELECT 'l_extendedprice' AS \"column\", 1.0::DOUBLE AS r "
       + "".join(f" UNION ALL SELECT '{c}', corr({c}, l_extendedprice) FROM lineitem" for c in _TC_COLS)
       + ") ORDER BY r DESC, \"column\" LIMIT 3")
def top_correlated_price(spark, d):
    top, _ = stats.top_correlated(table(spark, d, "lineitem"), "l_extendedprice", _TC_COLS, k=3)
    return round_doubles(top)


@query("class_balance_predictions", f"""
SELECT prediction, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent
FROM ({LONG_SCORES_SQL}) WHERE model = 's_mix' GROUP BY prediction""")
def class_balance_predictions(spark, d):
    ls = long_scores(spark, d).where(F.col("model") == "s_mix")
    return round_doubles(stats.class_balance(ls, "prediction"))


_FOLD_SQL = (f"(SELECT *, (row_number() OVER (PARTITION BY model, label ORDER BY md5('7:' || CAST(o_orderkey AS VARCHAR)), "
             f"o_orderkey) - 1) % 5 AS fold FROM ({LONG_SCORES_SQL}))")


def _folded_scores(spark, d):
    ls = long_scores(spark, d)
    base = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    folds = sampling.assign_folds(base, 5, "o_orderkey", "stratified", seed=7, label="label")
    return ls.join(folds.select("o_orderkey", "fold"), on="o_orderkey")


@query("score_summary_folds", f"""
WITH a AS (SELECT model, fold, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS acc FROM {_FOLD_SQL} GROUP BY 1, 2)
SELECT model, count(*) AS n, round(avg(acc), 6) AS mean, round(stddev_pop(acc), 6) AS std,
       round(2 * stddev_pop(acc), 6) AS two_std FROM a GROUP BY model""")
def score_summary_folds(spark, d):
    from ..operators.evaluate import accuracy
    per_fold = accuracy(_folded_scores(spark, d), "label", "prediction", by=["model", "fold"])
    return round_doubles(stats.score_summary(per_fold, ["model"], "accuracy"))


# ------------------------------------------------------------------ W
@query("sort_customers", """
SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey""")
def sort_customers(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return ranking.sort(c, "c_acctbal", descending=True, tiebreak="c_custkey")


_SPLIT_O = hdigit_sql("o_orderkey", "split")
_METRICS_SQL = f"""SELECT model, count(*) AS n,
  count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn
  FROM ({LONG_SCORES_SQL}) WHERE {{where}} GROUP BY model"""


def _f1_sql(t="m"):
    return f"CASE WHEN 2 * {t}.tp + {t}.fp + {t}.fn = 0 THEN 0.0 ELSE 2 * {t}.tp / (2 * {t}.tp + {t}.fp + {t}.fn) END"


def _test_metrics(spark, d, test=True):
    ls = long_scores(spark, d)
    cond = hdigit("o_orderkey", "split") >= "4"
    return binary_metrics(ls.where(cond if test else ~cond), "label", "prediction", by=["model"])


@query("leaderboard_models", f"""
WITH m AS ({_METRICS_SQL.format(where=_SPLIT_O + " >= '4'")})
SELECT model, round({_f1_sql()}, 6) AS f1, CAST(row_number() OVER (ORDER BY {_f1_sql()} DESC, model) AS INTEGER) AS position
FROM m QUALIFY position <= 2""")
def leaderboard_models(spark, d):
    res = _test_metrics(spark, d).select("model", "f1")
    return round_doubles(ranking.leaderboard(res, "f1", k=2))


@query("best_model_by_auc", f"""
WITH g AS (SELECT model, score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS q
           FROM ({LONG_SCORES_SQL}) GROUP BY 1, 2),
c AS (SELECT *, COALESCE(sum(q) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS qb FROM g),
a AS (SELECT model, sum(p * (qb + q / 2.0)) / (sum(p) * sum(q)) AS roc_auc FROM c GROUP BY model)
SELECT model, round(roc_auc, 6) AS roc_auc FROM a ORDER BY roc_auc DESC, model LIMIT 1""")
def best_model_by_auc(spark, d):
    auc = roc_auc(long_scores(spark, d), "label", "score", by=["model"])
    return round_doubles(ranking.best(auc, "roc_auc"))


@query("compare_to_baseline", f"""
WITH t AS ({_METRICS_SQL.format(where=_SPLIT_O + " >= '4'")}),
b AS ({_METRICS_SQL.format(where=_SPLIT_O + " < '4' AND model <> 's_noise'")}),
j AS (SELECT t.model, {_f1_sql('t')} AS f1, {_f1_sql('b')} AS baseline FROM t LEFT JOIN b ON t.model = b.model)
SELECT model, round(f1, 6) AS f1, round(baseline, 6) AS baseline, round(f1 - baseline, 6) AS improvement,
  CASE WHEN baseline IS NULL THEN NULL WHEN f1 - baseline > 0 THEN 'better' WHEN f1 - baseline < 0 THEN 'worse'
       ELSE 'same' END AS verdict FROM j""")
def compare_to_baseline(spark, d):
    res = _test_metrics(spark, d, True).select("model", "f1")
    base = _test_metrics(spark, d, False).where(F.col("model") != "s_noise").select("model", "f1")
    out = ranking.compare_to_baseline(res, base, "f1")
    return round_doubles(out.select("model", "f1", "baseline", "improvement", "verdict"))


# fixed values: candidate thresholds of the cross-validated ranking
CAND_THRESHOLDS = [0.4, 0.45, 0.5, 0.55, 0.6]


@query("rank_candidates_cv", f"""
WITH c AS (SELECT model, t, fold,
             count(*) FILTER (WHERE label = 1 AND score >= t) AS tp, count(*) FILTER (WHERE label = 0 AND score >= t) AS fp,
             count(*) FILTER (WHERE label = 1 AND score < t) AS fn
           FROM {_FOLD_SQL} CROSS JOIN (VALUES {', '.join(f'({t}::DOUBLE)' for t in CAND_THRESHOLDS)}) v(t)
           GROUP BY 1, 2, 3),
m AS (SELECT model, t, avg({_f1_sql('c')}) AS mean_score FROM c GROUP BY 1, 2)
SELECT model || '@' || CAST(CAST(t AS DECIMAL(4,2)) AS VARCHAR) AS candidate, round(mean_score, 6) AS mean_score,
       CAST(rank() OVER (ORDER BY round(mean_score, 9) DESC) AS INTEGER) AS rank FROM m""")
def rank_candidates_cv(spark, d):
    from ..operators.evaluate import threshold_sweep
    sweep = threshold_sweep(_folded_scores(spark, d), "label", "score", CAND_THRESHOLDS, by=["model", "fold"])
    cv = sweep.groupBy("model", "threshold").agg(F.avg("f1").alias("mean_score"))
    cv = cv.select(F.concat_ws("@", "model", F.col("threshold").cast("decimal(4,2)").cast("string")).alias("candidate"),
                   F.round("mean_score", 9).alias("mean_score"))
    return round_doubles(ranking.rank_candidates(cv, "mean_score"))
