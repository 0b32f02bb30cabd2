"""Catalogue part 6: rows that are easily lost or misplaced (NULL strata and
keys, NaN cells, string orders, more rows than a range sample, payload
columns) and the search layer on closed-form models, so that every fit,
fold, candidate and choice is checked against SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..models import bayes, knn, linear, moments, search
from ..operators import clean, encode, sampling
from .catalog_sample import _fold_sql
from .frames import MODEL_FRAME_SQL, hdigit, hdigit_sql, model_frame, null_if_hash, null_if_hash_sql, round_doubles, table
from .registry import query

SEED = 7

# ------------------------------------------------------------------ order primitives
_LI_KEY = "rid, price, q"


@query("folds_contiguous_payload", f"""
SELECT rid, price, q, {_fold_sql(f'(row_number() OVER (ORDER BY {_LI_KEY}) - 1)', 'count(*) OVER ()', 5)} AS fold
FROM ({MODEL_FRAME_SQL})""")
def folds_contiguous_payload(spark, d):
    """M6 with payload columns and more rows than the range sample holds."""
    m = model_frame(spark, d).select("rid", "price", "q", F.struct("rid", "price", "q").alias("k"))
    return sampling.assign_folds(m, 5, "k", "contiguous").select("rid", "price", "q", "fold")


_U = null_if_hash_sql("user_id", "event_id", "u", "3")
_V = null_if_hash_sql("value", "event_id", "v", "8")


@query("forward_fill_null_user_string_order", f"""
SELECT event_id, u AS user_id, last_value(v IGNORE NULLS) OVER (PARTITION BY u ORDER BY k
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM (SELECT event_id, {_U} AS u, {_V} AS v, event_type || ':' || CAST(event_id AS VARCHAR) AS k FROM events)""")
def forward_fill_null_user_string_order(spark, d):
    """A NULL key is a group; the order is text."""
    e = table(spark, d, "events").select(
        "event_id", null_if_hash("user_id", "event_id", "u", "3").alias("user_id"),
        null_if_hash("value", "event_id", "v", "8").alias("value"),
        F.concat_ws(":", "event_type", F.col("event_id").cast("string")).alias("k"))
    return clean.forward_fill(e, ["value"], ["k"], partition_by=["user_id"]).select("event_id", "user_id", "value")


# ------------------------------------------------------------------ NULL strata and keys
_STATUS = null_if_hash_sql("o_orderstatus", "o_orderkey", "st", "4")
_NULL_RANK = ("row_number() OVER (PARTITION BY s ORDER BY md5('{seed}:' || coalesce(CAST(k AS VARCHAR), '')), k NULLS FIRST)")


@query("stratified_folds_null_strata", f"""
SELECT k AS o_orderkey, s AS status, CAST(({_NULL_RANK.format(seed=SEED)} - 1) % 4 AS INTEGER) AS fold
FROM (SELECT o_orderkey AS k, {_STATUS} AS s FROM orders)""")
def stratified_folds_null_strata(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", null_if_hash("o_orderstatus", "o_orderkey", "st", "4").alias("status"))
    return sampling.assign_folds(o, 4, "o_orderkey", "stratified", SEED, label="status")


@query("stratified_split_null_strata", f"""
WITH r AS (SELECT k, s, {_NULL_RANK.format(seed=SEED)} AS rk FROM (SELECT o_orderkey AS k, {_STATUS} AS s FROM orders)),
c AS (SELECT s, count(*) AS nc FROM r GROUP BY s), t AS (SELECT sum(nc) AS n, ceil(0.25::DOUBLE * sum(nc)) AS t FROM c),
e AS (SELECT s, nc::DOUBLE * t / n AS exact, t FROM c CROSS JOIN t),
q AS (SELECT s, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, s NULLS FIRST)
             <= t - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS quota FROM e)
SELECT r.k AS o_orderkey, r.s AS status, CASE WHEN r.rk <= q.quota THEN 'test' ELSE 'train' END AS split
FROM r JOIN q ON r.s IS NOT DISTINCT FROM q.s""")
def stratified_split_null_strata(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", null_if_hash("o_orderstatus", "o_orderkey", "st", "4").alias("status"))
    return sampling.train_test_split(o, 0.25, SEED, "o_orderkey", stratify="status")


@query("split_null_keys", """
WITH k AS (SELECT CASE WHEN l_linenumber = 1 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS k FROM lineitem)
SELECT split, n, n_null FROM (
  SELECT CASE WHEN rk <= ceil(0.3::DOUBLE * total) THEN 'test' ELSE 'train' END AS split,
         count(*) AS n, count(*) FILTER (WHERE k IS NULL) AS n_null
  FROM (SELECT k, count(*) OVER () AS total, row_number() OVER (ORDER BY md5('7:' || coalesce(CAST(k AS VARCHAR), '')), k NULLS FIRST) AS rk FROM k)
  GROUP BY 1)""")
def split_null_keys(spark, d):
    """M3: rows with a NULL key are split like the others (counted, as such rows are alike)."""
    k = table(spark, d, "lineitem").select(
        F.when(F.col("l_linenumber") != 1, F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    s = sampling.train_test_split(k, 0.3, SEED, "k")
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("k").isNull()).alias("n_null"))


# ------------------------------------------------------------------ NaN counts as missing
_RK = "l_orderkey * 100 + l_linenumber"
_HOLE = {c: f"{hdigit_sql(_RK, 'nan' + c)}" for c in ("l_quantity", "l_discount", "l_tax")}
_HOLED_SQL = "SELECT l_orderkey, l_linenumber, l_returnflag, " + ", ".join(
    f"CASE WHEN {h} < '6' THEN NULL ELSE {c} END AS {c}" for c, h in _HOLE.items()) + " FROM lineitem"


def _holed(spark, d):
    """Cells lost as NULL (digit below 3) or NaN (3 to 5)."""
    rk = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    cell = lambda c: F.when(hdigit(rk, "nan" + c) < "3", F.lit(None)) \
        .when(hdigit(rk, "nan" + c) < "6", F.lit(float("nan"))).otherwise(F.col(c)).alias(c)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", *[cell(c) for c in _HOLE])


@query("fill_nan_cells", f"""
WITH h AS ({_HOLED_SQL}),
s AS (SELECT avg(l_quantity) AS a, median(l_discount) AS b FROM h),
m AS (SELECT l_tax AS t FROM h WHERE l_tax IS NOT NULL GROUP BY l_tax ORDER BY count(*) DESC, l_tax LIMIT 1)
SELECT l_orderkey, l_linenumber, round(coalesce(l_quantity, a), 6) AS l_quantity, round(coalesce(l_discount, b), 6) AS l_discount,
       round(coalesce(l_tax, t), 6) AS l_tax FROM h CROSS JOIN s CROSS JOIN m""")
def fill_nan_cells(spark, d):
    """C5 + C6 + C7 on cells that are NULL or NaN."""
    h = _holed(spark, d).drop("l_returnflag")
    h = clean.fill_stat(h, ["l_quantity"], "mean")
    h = clean.fill_stat(h, ["l_discount"], "median")
    return round_doubles(clean.fill_stat(h, ["l_tax"], "mode"))


@query("fill_nan_literal_group", f"""
WITH h AS ({_HOLED_SQL}), g AS (SELECT l_returnflag, median(l_discount) AS md FROM h GROUP BY l_returnflag)
SELECT l_orderkey, l_linenumber, round(coalesce(l_quantity, 0), 6) AS l_quantity, round(coalesce(l_discount, md), 6) AS l_discount
FROM h JOIN g USING (l_returnflag)""")
def fill_nan_literal_group(spark, d):
    """C4 + C8 on cells that are NULL or NaN."""
    h = clean.fill_literal(_holed(spark, d), {"l_quantity": 0.0})
    return round_doubles(clean.fill_group_median(h, "l_discount", "l_returnflag")
                         .select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"))


# ------------------------------------------------------------------ search layer, closed-form models
FOLDS = 3
NB_GRID = {"features": ["q", "q,tax", "q,disc,tax"]}
_FOLDED = f"""SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('{SEED}:' || rid), rid) - 1) % {FOLDS} AS INTEGER) AS fold
FROM ({MODEL_FRAME_SQL})"""


def _nb_cte(name: str, features: list[str], train_sql: str, test_sql: str, on: str) -> str:
    """CTEs fitting NB per value of ``fold`` in train_sql and predicting test_sql: ``<name>`` (fold, label, prediction)."""
    stats = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in features)
    eps = "1e-9 * greatest(" + ", ".join([f"var_pop({c})" for c in features] + ["0"]) + ")"
    terms = " + ".join(f"(-0.5 * ln(2 * pi() * (v_{c} + eps)) - ({c} - m_{c}) ** 2 / (2 * (v_{c} + eps)))" for c in features)
    return f"""{name}_tr AS ({train_sql}),
{name}_c AS (SELECT fold, label AS cl, count(*) AS n, {stats} FROM {name}_tr GROUP BY fold, label),
{name}_e AS (SELECT fold, {eps} AS eps, count(*) AS nt FROM {name}_tr GROUP BY fold),
{name}_lj AS (SELECT te.fold, te.rid, te.label, cl, ln(n / nt) + {terms} AS lj FROM ({test_sql}) te JOIN {name}_c c ON {on} JOIN {name}_e e ON e.fold = c.fold),
{name} AS (SELECT fold, rid, any_value(label) AS label, CASE WHEN max(lj) FILTER (WHERE cl = 1) > max(lj) FILTER (WHERE cl = 0) THEN 1 ELSE 0 END AS prediction
          FROM {name}_lj GROUP BY fold, rid)"""


def _scores(name: str) -> str:
    return (f"SELECT fold, count(*) FILTER (WHERE label = prediction) / count(*) AS accuracy, "
            f"2.0 * count(*) FILTER (WHERE label = 1 AND prediction = 1) / (2.0 * count(*) FILTER (WHERE label = 1 AND prediction = 1) "
            f"+ count(*) FILTER (WHERE label <> prediction)) AS f1 FROM {name} GROUP BY fold")


def _nb_cv_sql(grid: list[str]) -> str:
    parts, unions = [f"m AS MATERIALIZED ({_FOLDED})"], []
    for i, f in enumerate(grid):
        cols = f.split(",")
        parts.append(_nb_cte(f"p{i}", cols, f"SELECT h.fold, m.label, {', '.join('m.' + c for c in cols)} FROM m JOIN "
                             f"(SELECT DISTINCT fold FROM m) h ON m.fold <> h.fold", "SELECT * FROM m", "c.fold = te.fold"))
        unions.append(f"SELECT {i} AS candidate, * FROM ({_scores(f'p{i}')})")
    return "WITH " + ",\n".join(parts) + ", cv AS (" + " UNION ALL ".join(unions) + ")\n"


def _folded(spark, d):
    return sampling.assign_folds(model_frame(spark, d), FOLDS, "rid", "stratified", SEED, label="label")


def _fit_nb(df, features):
    return bayes.fit_gaussian_nb(df, features.split(","), "label")


@query("nb_cross_validate", _nb_cv_sql(NB_GRID["features"]) +
       "SELECT candidate, fold, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1 FROM cv")
def nb_cross_validate(spark, d):
    """V8/V9: two metrics of every (candidate, fold)."""
    cv = search.cross_validate(_fit_nb, _folded(spark, d), candidates=search.expand_grid(NB_GRID))
    return round_doubles(cv.select("candidate", "fold", "accuracy", "f1"))


_BEST = ("SELECT candidate, avg(f1) AS mean_score, stddev_pop(f1) AS std_score FROM cv GROUP BY candidate")


@query("nb_grid_search", _nb_cv_sql(NB_GRID["features"]) + f"""
SELECT candidate, round(mean_score, 6) AS mean_score, round(std_score, 6) AS std_score,
       row_number() OVER (ORDER BY mean_score DESC, candidate) = 1 AS chosen FROM ({_BEST})""")
def nb_grid_search(spark, d):
    """Mean and spread of every candidate, and the one that was refitted."""
    rec, cv, _ = search.grid_search(_fit_nb, _folded(spark, d), None, NB_GRID, metric="f1")
    chosen = F.element_at(F.from_json("params", "map<string,string>"), "features") == rec["params"]["features"]
    return round_doubles(cv.select("candidate", "mean_score", "std_score", chosen.alias("chosen")))


_RANDOM = search.random_candidates({"features": ["q", "disc", "tax", "price", "q,disc", "q,price"]}, 3, seed=SEED)


@query("nb_random_search", _nb_cv_sql([c["features"] for c in _RANDOM]) + f"""
SELECT CASE candidate {' '.join(f"WHEN {i} THEN '{c['features']}'" for i, c in enumerate(_RANDOM))} END AS features,
       round(mean_score, 6) AS mean_score FROM ({_BEST})""")
def nb_random_search(spark, d):
    """Three candidates drawn by ``random_candidates``, cross-validated."""
    _, cv, _ = search.grid_search(_fit_nb, _folded(spark, d), None, _RANDOM, metric="f1")
    return round_doubles(cv.select(F.element_at(F.from_json("params", "map<string,string>"), "features").alias("features"), "mean_score"))


_EVAL = {"nb_q": "q", "nb_tax": "tax", "nb_all": "q,disc,tax,price"}


def _nb_eval_sql() -> str:
    parts, unions = [f"m AS MATERIALIZED ({MODEL_FRAME_SQL})"], []
    for n, f in _EVAL.items():
        parts.append(_nb_cte(n, f.split(","), f"SELECT 0 AS fold, * FROM m WHERE {hdigit_sql('rid', 'nb')} < 'c'",
                             f"SELECT 0 AS fold, * FROM m WHERE {hdigit_sql('rid', 'nb')} >= 'c'", "c.fold = te.fold"))
        unions.append(f"SELECT '{n}' AS model, 'ok' AS status, round(accuracy, 6) AS test_accuracy, round(f1, 6) AS test_f1 FROM ({_scores(n)})")
    return "WITH " + ",\n".join(parts) + "\n" + " UNION ALL ".join(unions)


@query("nb_evaluate_models", _nb_eval_sql())
def nb_evaluate_models(spark, d):
    """Fit, score and record several models."""
    m = model_frame(spark, d)
    is_train = hdigit("rid", "nb") < "c"
    fits = {n: (lambda df, f=f: _fit_nb(df, f)) for n, f in _EVAL.items()}
    res = search.evaluate_models(fits, m.where(is_train), m.where(~is_train))
    return round_doubles(res.select("model", "status", "test_accuracy", "test_f1"))


_SWEEP = {"nb_two": ["q,tax", "q,disc"], "nb_one": ["q", "disc"]}


def _nb_sweep_sql() -> str:
    parts, unions = [f"m AS MATERIALIZED ({MODEL_FRAME_SQL})"], []
    for n, fs in _SWEEP.items():
        for i, f in enumerate(fs):
            parts.append(_nb_cte(f"{n}{i}", f.split(","), f"SELECT 0 AS fold, * FROM m WHERE {hdigit_sql('rid', 'nb')} < 'c'",
                                 f"SELECT 0 AS fold, * FROM m WHERE {hdigit_sql('rid', 'nb')} >= 'c'", "c.fold = te.fold"))
            unions.append(f"SELECT '{n}' AS model, '{f}' AS features, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1 "
                          f"FROM ({_scores(f'{n}{i}')})")
    return "WITH " + ",\n".join(parts) + "\n" + " UNION ALL ".join(unions)


@query("nb_sweep", _nb_sweep_sql())
def nb_sweep(spark, d):
    """Two models over their parameter ranges."""
    m = model_frame(spark, d)
    is_train = hdigit("rid", "nb") < "c"
    s = search.sweep({n: (_fit_nb, {"features": fs}) for n, fs in _SWEEP.items()}, m.where(is_train), m.where(~is_train))
    return round_doubles(s.select("model", F.element_at(F.from_json("params", "map<string,string>"), "features").alias("features"),
                                  "accuracy", "f1"))


ALPHAS = [0.0, 100.0, 10000.0]


@query("ridge_cross_validate", f"""
WITH m AS MATERIALIZED ({_FOLDED}), h AS (SELECT DISTINCT fold FROM m),
s AS (SELECT h.fold, avg(q) AS mx, avg(y_reg) AS my, var_pop(q) * count(*) AS sxx, covar_pop(q, y_reg) * count(*) AS sxy
      FROM m JOIN h ON m.fold <> h.fold GROUP BY h.fold)
SELECT a.candidate, m.fold, round(sqrt(avg((y_reg - (my + sxy / (sxx + a.alpha) * (q - mx))) ** 2)), 5) AS rmse
FROM m JOIN s ON m.fold = s.fold CROSS JOIN (VALUES {', '.join(f'({i}, {a})' for i, a in enumerate(ALPHAS))}) a(candidate, alpha)
GROUP BY a.candidate, m.fold""")
def ridge_cross_validate(spark, d):
    """L9 + L13 + V8 for regression: one-feature ridge, in closed form in SQL."""
    m = encode.assemble(_folded(spark, d), ["q"]).select("features", "y_reg", "fold")
    cv = search.cross_validate(moments.FoldFit(linear.fit_ridge, "ridge", label="y_reg"), m, label="y_reg",
                               task="regression", candidates=[{"alpha": a} for a in ALPHAS])
    return round_doubles(cv.select("candidate", "fold", "rmse"), 5)


_KNN_SPLIT = hdigit_sql("vec_id", "knn")


@query("knn_manhattan_distance_weights", f"""
WITH tr AS (SELECT 'v' || CAST(vec_id AS VARCHAR) AS id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE {_KNN_SPLIT} < 'c'),
te AS (SELECT 'v' || CAST(vec_id AS VARCHAR) AS id, embedding::DOUBLE[] AS e FROM embeddings WHERE {_KNN_SPLIT} >= 'c'),
d AS (SELECT te.id AS q, tr.id AS t, tr.label, list_sum([abs(x[1] - x[2]) FOR x IN list_zip(te.e, tr.e)]) AS dist FROM te CROSS JOIN tr),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY dist, t) AS rk FROM d QUALIFY rk <= 7),
v AS (SELECT q, label, sum(1 / dist) AS votes FROM r GROUP BY q, label)
SELECT q AS id, 7 AS k, label AS prediction FROM v QUALIFY row_number() OVER (PARTITION BY q ORDER BY votes DESC, label) = 1""")
def knn_manhattan_distance_weights(spark, d):
    """L4 with text keys, the city-block metric and distance weights."""
    emb = table(spark, d, "embeddings").withColumn("id", F.concat(F.lit("v"), F.col("vec_id").cast("string")))
    is_train = hdigit("vec_id", "knn") < "c"
    nb = knn.knn_neighbors(emb.where(is_train), emb.where(~is_train), "embedding", "label", "id", "id", k=7, metric="manhattan")
    return knn.knn_predict(nb, "id", [7], weights="distance").select("id", "k", "prediction")
