"""Cross-validation, grid / random search, coarse-to-fine refinement and
the train-and-evaluate loop (V8-V13, V16).

Each fit is a distributed Spark job; the driver only loops over
candidates (optionally several fits at once, like
``CrossValidator(parallelism=...)``). Held-out folds of every candidate are
scored, tagged and unioned, and *all* metrics for all (candidate, fold)
pairs come out of one aggregate.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import time
import traceback
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.evaluate import binary_metrics, regression_metrics, roc_auc
from ..session import cut_lineage
from .cells import SPREAD
from .score import score as score_frame

RESULT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("status", T.StringType()), T.StructField("metric", T.StringType()),
    T.StructField("cv_mean", T.DoubleType()), T.StructField("cv_std", T.DoubleType()),
    T.StructField("test_accuracy", T.DoubleType()), T.StructField("test_f1", T.DoubleType()),
    T.StructField("test_roc_auc", T.DoubleType()), T.StructField("test_rmse", T.DoubleType()),
    T.StructField("time_min", T.DoubleType()), T.StructField("timestamp", T.StringType()),
    T.StructField("error", T.StringType())])


def expand_grid(grid) -> list[dict]:
    """A dict of lists, or a list of such dicts -> list of parameter dicts
    (V12: the cartesian sweep)."""
    grids = grid if isinstance(grid, list) else [grid]
    out = []
    for g in grids:
        keys = sorted(g)
        out += [dict(zip(keys, vals)) for vals in itertools.product(*[g[k] for k in keys])]
    return out


def as_candidates(grid) -> list[dict]:
    """A grid (dict of lists / list of such dicts) or an explicit list of
    parameter dicts -> list of parameter dicts."""
    if isinstance(grid, dict):
        return expand_grid(grid)
    grid = list(grid)
    if grid and all(isinstance(v, (list, tuple)) for v in grid[0].values()):
        return expand_grid(grid)
    return grid


def sweep(fits: dict, train: DataFrame, test: DataFrame, label: str = "label", task: str = "classification",
          cut: bool = True) -> DataFrame:
    """Models x parameter ranges -> one long score table.

    ``fits``: name -> (fit, grid). One row per (model, parameters) with every
    test metric, all scored rows aggregated together."""
    if cut:
        train, test = cut_lineage(train), cut_lineage(test)
    parts = []
    for name, (fit, grid) in fits.items():
        for params in as_candidates(grid):
            model = fit(train, **params)
            s = score_frame(model, test, keep=[label]) if task == "classification" else \
                model.transform(test).select(label, F.col("prediction").cast("double"))
            parts.append(s.withColumns({"model": F.lit(name), "params": F.lit(candidate_id(params))}))
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    if task == "classification":
        scored = cut_lineage(scored)
    return _metrics(scored, task, label, ["model", "params"])


def candidate_id(params: dict) -> str:
    return json.dumps(params, sort_keys=True, default=str)


def random_candidates(grid, n_iter: int, seed) -> list[dict]:
    """``n_iter`` candidates of the grid in md5(seed ':' id) order
    (repeatable, same rule as the row samplers)."""
    cands = expand_grid(grid)
    key = lambda p: (hashlib.md5(f"{seed}:{candidate_id(p)}".encode()).hexdigest(), candidate_id(p))
    return sorted(cands, key=key)[:n_iter]


def refine_grid(best: dict, steps: dict, lower: dict | None = None) -> dict:
    """Second grid around the best of the first: each stepped
    parameter becomes [best - step, best, best + step] (kept above
    ``lower``); other parameters stay fixed."""
    out = {}
    for k, v in best.items():
        if k in steps and isinstance(v, (int, float)):
            s = steps[k]
            vals = [v - s, v, v + s]
            lo = (lower or {}).get(k)
            vals = [x for x in vals if lo is None or x > lo]
            out[k] = sorted(set(type(v)(x) if isinstance(v, int) else round(x, 10) for x in vals))
        else:
            out[k] = [v]
    return out


def _metrics(scored: DataFrame, task: str, label: str, by, weight: str | None = None) -> DataFrame:
    if task == "classification":
        m = binary_metrics(scored, label, "prediction", by=by, weight=weight)
        a = roc_auc(scored, label, "score", by=by, weight=weight)
        return m.join(a, on=by, how="left")
    return regression_metrics(scored, label, "prediction", by=by, weight=weight, spread=SPREAD if weight else None)


def cross_validate(fit, df: DataFrame, fold_col: str = "fold", label: str = "label", task: str = "classification",
                   candidates=None, keep=(), parallelism: int = 1, cut: bool = True, weight: str | None = None) -> DataFrame:
    """V8/V9: for every candidate (a dict passed to ``fit(train_df, **params)``)
    and fold f: fit on the other folds, score fold f. Returns one row per
    (candidate, fold) with every metric (accuracy, f1, auc or rmse ...),
    computed by one aggregate over the union of scored folds. ``weight``
    names the column of a counted table (``cells``) that
    holds how many rows a row stands for. A regression whose fit has
    ``fold_lines`` (``moments.FoldFit``) takes two passes over ``df``, whatever
    the number of candidates and folds."""
    candidates = candidates or [{}]
    if weight:
        keep = (*keep, weight, *([] if task == "classification" else [SPREAD]))
    if cut:  # every fit iterates over the input: give it a short lineage
        df = cut_lineage(df)
    lines = fit.fold_lines(df, fold_col, candidates) if task == "regression" and hasattr(fit, "fold_lines") else None
    if lines is not None:
        return _metrics(_score_lines(df, *lines, fold_col, label, keep), task, label, ["candidate", fold_col])
    folds = sorted(r[0] for r in df.select(fold_col).distinct().collect())  # k values
    jobs = [(ci, f) for ci in range(len(candidates)) for f in folds]

    def run(job):
        ci, f = job
        model = fit(df.where(F.col(fold_col) != f), **candidates[ci])
        held = df.where(F.col(fold_col) == f)
        if task == "classification":
            s = score_frame(model, held, keep=[label, *keep])
        else:
            s = model.transform(held).select(label, *keep, F.col("prediction").cast("double"))
        return s.withColumn("candidate", F.lit(ci)).withColumn(fold_col, F.lit(f))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        parts = list(ex.map(run, jobs))
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    if task == "classification":  # read by the counts and by the AUC
        scored = cut_lineage(scored)
    return _metrics(scored, task, label, ["candidate", fold_col], weight)


def _score_lines(df: DataFrame, inputs, lines: dict, fold_col: str, label: str, keep) -> DataFrame:
    """Each row under the lines of its own fold, one row per candidate."""
    folds, n = list(dict.fromkeys(f for _, f in lines)), 1 + max(i for i, _ in lines)

    def of_fold(value):
        out = None
        for f in folds:
            out = F.when(F.col(fold_col) == f, F.lit(value(f))) if out is None else out.when(F.col(fold_col) == f, F.lit(value(f)))
        return out

    names = [f"_x{i}" for i in range(len(inputs))]
    pred = []
    for i in range(n):
        y = of_fold(lambda f: float(lines[i, f][1]))  # noqa: B023
        for j, x in enumerate(names):
            y = y + of_fold(lambda f: float(lines[i, f][0][j])) * F.col(x)  # noqa: B023
        pred.append(F.struct(F.lit(i).alias("candidate"), y.alias("prediction")))
    return df.select(label, *keep, fold_col, *[x.cast("double").alias(c) for x, c in zip(inputs, names)]).select(
        label, *keep, of_fold(lambda f: f).alias(fold_col), F.explode(F.array(*pred)).alias("_p")).select(label, *keep, fold_col, "_p.*")


def grid_search(fit, train: DataFrame, test: DataFrame | None, grid, metric: str = "f1", fold_col: str = "fold",
                label: str = "label", task: str = "classification", name: str = "model", parallelism: int = 1,
                higher_is_better: bool = True, cut: bool = True, weight: str | None = None):
    """CV over every candidate, pick the best mean ``metric`` (ties ->
    first candidate), refit it on all of ``train`` and measure ``test``.
    Returns (result row dict, per-candidate cv DataFrame, refit model)."""
    t0 = time.time()
    cands = as_candidates(grid)
    if cut:
        train = cut_lineage(train)
    cv = cross_validate(fit, train, fold_col, label, task, cands, parallelism=parallelism, cut=False, weight=weight)
    summary = cv.groupBy("candidate").agg(F.avg(metric).alias("mean_score"), F.stddev_pop(metric).alias("std_score"))
    sign = -1 if higher_is_better else 1  # one row per candidate; a candidate without a score comes last
    rows = sorted(summary.collect(), key=lambda r: (r["mean_score"] is None, sign * (r["mean_score"] or 0.0), r["candidate"]))
    best = rows[0]
    params = cands[best["candidate"]]
    model = fit(train.drop(fold_col), **params)
    rec = {"model": name, "params": {k: str(v) for k, v in params.items()}, "status": "ok", "metric": metric,
           "cv_mean": None if best["mean_score"] is None else float(best["mean_score"]), "cv_std": float(best["std_score"] or 0.0)}
    if test is not None:
        rec.update(_test_metrics(model, test, label, task, weight))
    rec["time_min"] = (time.time() - t0) / 60.0
    rec["timestamp"] = datetime.now(timezone.utc).isoformat(timespec="seconds")
    cv_table = summary.withColumn("params", F.element_at(
        F.array(*[F.lit(candidate_id(c)) for c in cands]), (F.col("candidate") + 1).cast("int")))
    return rec, cv_table, model


def fingerprint(df: DataFrame) -> str:
    """Number of rows and an order-free sum of their hashes: the same rows give the same text."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s")).first()
    return f"{r['n']}:{r['s']}"


def resumable_search(fit, train: DataFrame, grid, log: str, name: str = "model", metric: str = "f1", fold_col: str = "fold",
                     label: str = "label", task: str = "classification", higher_is_better: bool = True, version: str = "") -> DataFrame:
    """V10 / V16 with S5: (candidate, params, mean_score, std_score, position) of every candidate, from the log where it is finished.

    A candidate's record lies in its own folder of ``log``, named by the search's
    name, its parameters, metric, ``version`` (of the fitting code, if the caller
    gives one) and the fingerprint of the training rows; it is written whole
    once its folds are scored. A search that was killed fits only what has no
    record; writing a record again replaces it, so two runs at once end in the
    same log. Other data, parameters or versions never match.
    """
    spark, cands = train.sparkSession, as_candidates(grid)
    train = cut_lineage(train)
    data = fingerprint(train)
    keys = [hashlib.md5("\n".join([name, metric, task, version, data, candidate_id(c)]).encode()).hexdigest() for c in cands]
    done = {r["key"]: r for r in _read_log(spark, log, keys)}
    for i, (key, params) in enumerate(zip(keys, cands)):
        if key in done:
            continue
        cv = cross_validate(fit, train, fold_col, label, task, [params], cut=False)
        r = cv.agg(F.avg(metric).cast("double").alias("mean_score"), F.stddev_pop(metric).cast("double").alias("std_score"))
        out = r.select(F.lit(key).alias("key"), F.lit(name).alias("model"), F.lit(candidate_id(params)).alias("params"),
                       F.lit(metric).alias("metric"), F.lit(data).alias("data"), "mean_score", "std_score")
        out.coalesce(1).write.mode("overwrite").json(f"{log}/{key}")
    rows = {r["key"]: r for r in _read_log(spark, log, keys)}
    sign = -1 if higher_is_better else 1
    order = sorted(range(len(cands)), key=lambda i: (rows[keys[i]]["mean_score"] is None, sign * (rows[keys[i]]["mean_score"] or 0.0), i))
    return spark.createDataFrame(
        [(i, candidate_id(cands[i]), rows[keys[i]]["mean_score"], rows[keys[i]]["std_score"], order.index(i) + 1) for i in range(len(cands))],
        "candidate int, params string, mean_score double, std_score double, position int")


_LOG = "key string, model string, params string, metric string, data string, mean_score double, std_score double"


def _read_log(spark, log: str, keys) -> list:
    """Finished records of the given keys; a folder without Spark's success mark is not finished."""
    sc = spark.sparkContext
    paths = []
    for k in dict.fromkeys(keys):
        p = sc._jvm.org.apache.hadoop.fs.Path(f"{log}/{k}/_SUCCESS")
        if p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p):
            paths.append(f"{log}/{k}")
    return spark.read.schema(_LOG).json(paths).collect() if paths else []


def _test_metrics(model, test: DataFrame, label: str, task: str, weight: str | None = None) -> dict:
    if task == "classification":
        s = score_frame(model, test, keep=[label, *([weight] if weight else [])]).withColumn("_g", F.lit(0))
        m = _metrics(s, task, label, ["_g"], weight).first()
        return {"test_accuracy": float(m["accuracy"]), "test_f1": float(m["f1"]),
                "test_roc_auc": None if m["roc_auc"] is None else float(m["roc_auc"])}
    s = model.transform(test).select(label, F.col("prediction").cast("double")).withColumn("_g", F.lit(0))
    m = _metrics(s, task, label, ["_g"]).first()
    return {"test_rmse": float(m["rmse"])}


def evaluate_models(models: dict, train: DataFrame, test: DataFrame, label: str = "label",
                    task: str = "classification", spark=None, cut: bool = True, weight: str | None = None) -> DataFrame:
    """Fit every named model (``name -> fit(train) -> model``), score
    the test frame, record metrics, elapsed time and timestamp. A failing
    model (or a missing library) becomes a row with status 'error'."""
    spark = spark or train.sparkSession
    if cut:
        train = cut_lineage(train)
    recs = []
    for name, fit in models.items():
        t0 = time.time()
        rec = {"model": name, "params": {}, "metric": "f1" if task == "classification" else "rmse"}
        try:
            model = fit(train)
            rec.update(_test_metrics(model, test, label, task, weight))
            rec["status"] = "ok"
        except Exception as e:  # recorded, not raised: the loop goes on
            rec["status"] = "error"
            rec["error"] = f"{type(e).__name__}: {e}"
            traceback.print_exc(limit=1)
        rec["time_min"] = (time.time() - t0) / 60.0
        rec["timestamp"] = datetime.now(timezone.utc).isoformat(timespec="seconds")
        recs.append(rec)
    return results_frame(spark, recs)


def results_frame(spark, recs) -> DataFrame:
    """Result records (one per fitted model/candidate) -> DataFrame."""
    names = [f.name for f in RESULT_SCHEMA.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in recs], RESULT_SCHEMA)
