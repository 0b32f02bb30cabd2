"""Logistic regressions and linear SVCs fitted together: Newton steps of all candidates and folds from one aggregate each.

Every iteration sends the current coefficients of all open fits to the tasks;
a task computes, per fit, loss, gradient and Hessian over its blocks as matrix
products (rows x fits), leaving out the rows of the fit's own fold. The sums
come back as one array; the driver takes a Newton step on (d + 1) x (d + 1)
matrices per fit. L1 penalties take a proximal Newton step: the quadratic
model plus penalty, solved by coordinate descent. A step that does not lower
the objective is halved, so fits do not depend on a lucky start; the number of
jobs is that of the slowest fit's iterations, whatever the number of fits.

Parameters follow the reference: ``C`` scales the sum of the losses, the
intercept is not penalised (but for the SVC, whose intercept is a coefficient
like the others), ``balanced`` weighs classes by n / (k n_c) of the rows that
the fit trains on. The SVC's loss is the squared hinge; its Hessian counts the
rows inside the margin.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import StateModel
from .blocks import Block, features_column, pack, release, sum_arrays
from .search import _test_metrics, as_candidates, candidate_id


@dataclass
class Fit:
    """One fit: penalty, loss and the fold it leaves out (None: trains on all rows)."""
    C: float = 1.0
    penalty: str = "l2"
    fold: int | None = None
    balanced: bool = False
    fit_intercept: bool = True
    loss: str = "logistic"
    # state
    w: np.ndarray | None = None
    objective: float = math.inf
    base: np.ndarray | None = None
    step: np.ndarray | None = None
    size: float = 1.0
    done: bool = False
    iterations: int = 0
    class_weights: tuple = (1.0, 1.0)


def _pair_index(d: int):
    return np.triu_indices(d)


#: cells (rows x fits) of one step of a sum: its arrays stay in a core's cache
CELLS = 32_768


def _pieces(block: Block, fits: int):
    """Rows of one fold and class, in pieces of about ``CELLS`` rows x fits: (fold, class, Block)."""
    n, code = max(256, CELLS // max(fits, 1)), block.fold.astype(np.int64) * 2 + (block.y > 0)
    order = np.argsort(code, kind="stable")
    keys, starts = np.unique(code[order], return_index=True)
    for k, lo, hi in zip(keys.tolist(), starts, [*starts[1:], len(order)]):
        for i in range(lo, hi, n):
            at = order[i:min(i + n, hi)]
            yield k >> 1, k & 1, Block(block.x[at], block.y[at], block.w[at], block.fold[at])


def _sums(block: Block, coefs: np.ndarray, folds: np.ndarray, class_weights: np.ndarray, hinge: bool = False) -> np.ndarray:
    """Per fit: loss, gradient, upper triangle of the Hessian, over the rows it trains on.

    Rows come by fold and class, so a fit that leaves the fold out is not computed at all and a class weight multiplies sums, not rows.
    """
    i, j = _pair_index(coefs.shape[1])
    out = np.zeros((len(coefs), 1 + coefs.shape[1] + len(i)))
    for fold, cls, b in _pieces(block, len(coefs)):
        on = folds != fold
        if not on.any():
            continue
        x, w = np.column_stack([b.x, np.ones(len(b.y))]) * (1.0 if cls else -1.0), b.w[:, None]
        m = x @ coefs[on].T                                     # the signed margin
        if hinge:
            short = np.maximum(1 - m, 0)
            ws = w * short
            loss, grad = np.einsum("ij,ij->j", ws, short), -2 * (ws.T @ x)
            hess = 2 * ((w * (short > 0)).T @ (x[:, i] * x[:, j]))
        else:
            t = np.exp(-np.abs(m))
            p = np.where(m > 0, t, 1.0) / (1 + t)               # probability of the other class
            loss = (w * (np.maximum(-m, 0) + np.log(1 + t))).sum(axis=0)      # log(1 + exp(-m))
            wp = w * p
            grad, hess = -(wp.T @ x), (wp * (1 - p)).T @ (x[:, i] * x[:, j])
        out[on] += class_weights[on, cls][:, None] * np.concatenate([loss[:, None], grad, hess], axis=1)
    return out.ravel()


def _held(f: Fit, d: int) -> np.ndarray:
    """1 for penalised coefficients: all but the intercept of a logistic regression."""
    out = np.ones(d)
    out[-1] = float(f.loss == "squared_hinge")
    return out


def _penalty(f: Fit, w: np.ndarray) -> float:
    v = w * _held(f, len(w))
    return (0.5 * float(v @ v) if f.penalty == "l2" else float(np.abs(v).sum())) / f.C


def _newton_step(f: Fit, w, grad, hess) -> np.ndarray:
    """Minimiser of the quadratic model (plus L1 penalty) less w."""
    d = len(w)
    free = np.ones(d, bool)
    free[-1] = f.fit_intercept
    lam, held = 1.0 / f.C, _held(f, d)
    if f.penalty == "l2":
        g, h = grad + lam * held * w, hess + lam * np.diag(held)
        out = np.zeros(d)
        h = h + 1e-12 * max(np.trace(h), 1e-300) / d * np.eye(d)
        out[free] = -np.linalg.lstsq(h[np.ix_(free, free)], g[free], rcond=None)[0]
        return out
    h = hess + 1e-12 * max(np.trace(hess), 1e-300) / d * np.eye(d)
    v = w.copy()
    for _ in range(10_000):
        moved = 0.0
        for j in np.flatnonzero(free):
            r = h[j, j] * v[j] - (grad[j] + h[j] @ (v - w))
            new = math.copysign(max(abs(r) - lam * held[j], 0.0), r) / h[j, j]
            moved = max(moved, abs(new - v[j]))
            v[j] = new
        if moved < 1e-14 * max(1.0, np.abs(v).max()):
            break
    return v - w


def solve(blocks: DataFrame, fits: list[Fit], features: int, tol: float = 1e-9, max_iter: int = 60) -> int:
    """Fit all of ``fits`` in place; returns the number of jobs (aggregates)."""
    d, jobs = features + 1, 0
    for f in fits:
        f.w = np.zeros(d)
    i, j = _pair_index(d)
    while jobs < max_iter and any(not f.done for f in fits):
        live = [f for f in fits if not f.done]
        coefs = np.stack([f.w for f in live])
        folds = np.array([-2 if f.fold is None else f.fold for f in live])
        weights = np.array([f.class_weights for f in live])
        hinge = live[0].loss == "squared_hinge"
        if any((f.loss == "squared_hinge") != hinge for f in live):
            raise ValueError("fits of one batch share their loss")
        s = sum_arrays(blocks, lambda b: _sums(b, coefs, folds, weights, hinge))  # noqa: B023
        jobs += 1
        if not len(s):
            raise ValueError("no complete rows to fit on")
        for f, row in zip(live, s.reshape(len(live), -1)):
            loss, grad = row[0], row[1:1 + d]
            hess = np.zeros((d, d))
            hess[i, j] = hess[j, i] = row[1 + d:]
            value = loss + _penalty(f, f.w)
            f.iterations += 1
            if value > f.objective + 1e-12 * abs(f.objective) and f.size > 1e-8:
                f.size /= 2                                    # the step went too far
                f.w = f.base + f.size * f.step
                continue
            f.objective = value
            step = _newton_step(f, f.w, grad, hess)
            if np.abs(step).max() <= tol * max(1.0, np.abs(f.w).max()):
                f.w, f.done = f.w + step, True                  # the last step of a quadratic method needs no look back
                continue
            f.base, f.step, f.size = f.w, step, 1.0
            f.w = f.w + step
    return jobs


def _linear(features, coefficients, intercept):
    """The decision value as a column."""
    if isinstance(features, str):
        return lambda x: F.aggregate(F.zip_with(x, F.lit(coefficients), lambda u, v: u * v), F.lit(intercept), lambda s, t: s + t)
    return lambda _: sum((F.lit(c) * F.col(f"`{n}`").cast("double") for n, c in zip(features, coefficients)), F.lit(intercept))


class NewtonLogisticModel(StateModel):
    """Coefficients and intercept; adds ``prediction`` and ``probability`` (of class 1)."""

    def __init__(self, features=None, coefficients=None, intercept: float = 0.0):
        super().__init__(None if features is None else {"features": features, "coefficients": [float(c) for c in coefficients],
                                                        "intercept": float(intercept)})

    @property
    def coefficients(self):
        return Vectors.dense(self.learned["coefficients"])

    @property
    def intercept(self):
        return self.learned["intercept"]

    def _transform(self, df: DataFrame) -> DataFrame:
        a = self.learned
        z = _linear(a["features"], a["coefficients"], a["intercept"])(features_column(df, a["features"]))
        return df.withColumn("_z", z).withColumn("prediction", (F.col("_z") > 0).cast("double")) \
            .withColumn("probability", 1.0 / (1.0 + F.exp(-F.col("_z")))).drop("_z")


class NewtonSVCModel(NewtonLogisticModel):
    """Coefficients and intercept; adds ``prediction`` and ``rawPrediction`` (the decision value of both classes)."""

    def _transform(self, df: DataFrame) -> DataFrame:
        a = self.learned
        z = _linear(a["features"], a["coefficients"], a["intercept"])(features_column(df, a["features"]))
        return df.withColumn("_z", z).withColumn("prediction", (F.col("_z") > 0).cast("double")) \
            .withColumn("rawPrediction", array_to_vector(F.array(-F.col("_z"), F.col("_z")))).drop("_z")


def _class_weights(fits: list[Fit], counts: dict) -> None:
    """counts: {(fold, class): rows}; balanced weights of the rows each fit trains on."""
    for f in fits:
        if f.balanced:
            n = [sum(c for (k, y), c in counts.items() if y == cls and (f.fold is None or k != f.fold)) for cls in (0, 1)]
            k = sum(x > 0 for x in n)
            f.class_weights = tuple(sum(n) / (k * x) if x else 0.0 for x in n)


def fit_logistic_batch(df: DataFrame, fits: list[Fit], features="features", label: str = "label", weight_col: str | None = None,
                       fold_col: str | None = None, tol: float = 1e-9, max_iter: int = 60):
    """Fit many logistic regressions on the same rows: ([model], number of aggregates).

    ``fold_col`` holds small integers; a fit with ``fold`` set leaves those rows out.
    """
    blocks = pack(df, features, label, weight_col, fold_col)
    out = fit_blocks(blocks, fits, features, tol, max_iter)
    release(blocks)
    return out


def fit_blocks(blocks: DataFrame, fits: list[Fit], features="features", tol: float = 1e-9, max_iter: int = 60):
    first = blocks.select((F.octet_length("x") / F.col("n") / 8).cast("int")).first()
    if first is None:
        raise ValueError("no complete rows to fit on")
    if any(f.balanced for f in fits):
        folds = sorted({f.fold for f in fits if f.fold is not None})
        keys = np.array(folds + [-(10 ** 9)])                  # the last one gathers every other fold

        def count(b: Block) -> np.ndarray:
            at = np.searchsorted(keys[:-1], b.fold)
            at = np.where((at < len(folds)) & (keys[np.minimum(at, len(folds))] == b.fold), at, len(folds))
            return np.bincount(at * 2 + (b.y > 0), minlength=2 * len(keys)).astype(np.float64)
        n = sum_arrays(blocks, count)
        _class_weights(fits, {(int(keys[k]), c): n[2 * k + c] for k in range(len(keys)) for c in (0, 1)})
    jobs = solve(blocks, fits, first[0], tol, max_iter)
    return [(NewtonSVCModel if f.loss == "squared_hinge" else NewtonLogisticModel)(features, f.w[:-1], f.w[-1]) for f in fits], jobs


def fit_logistic_newton(df: DataFrame, features="features", label: str = "label", C: float = 1.0, penalty: str = "l2",
                        balanced: bool = False, weight_col: str | None = None, fit_intercept: bool = True) -> NewtonLogisticModel:
    """L1: one logistic regression (see ``linear.fit_logistic``) in a few aggregates over packed blocks."""
    fit = Fit(C=C, penalty=penalty, balanced=balanced, fit_intercept=fit_intercept)
    return fit_logistic_batch(df, [fit], features, label, weight_col)[0][0]


def fit_svc_newton(df: DataFrame, features="features", label: str = "label", C: float = 1.0, penalty: str = "l1",
                   balanced: bool = False, weight_col: str | None = None, fit_intercept: bool = True) -> NewtonSVCModel:
    """L2: linear SVC with squared hinge loss and an L1 or L2 penalty: C * sum of losses + |w|_1 (or |w|^2 / 2)."""
    fit = Fit(C=C, penalty=penalty, balanced=balanced, fit_intercept=fit_intercept, loss="squared_hinge")
    return fit_logistic_batch(df, [fit], features, label, weight_col)[0][0]


def held_out_counts(blocks: DataFrame, fits: list[Fit]) -> np.ndarray:
    """(fit, [tp, fp, fn, tn]) of each fit on the fold it left out, from one aggregate."""
    coefs = np.stack([f.w for f in fits])
    folds = np.array([f.fold for f in fits])

    def count(block: Block) -> np.ndarray:
        out = np.zeros((4, len(fits)))
        for fold, cls, b in _pieces(block, len(fits)):
            mine = folds == fold
            hit = ((np.column_stack([b.x, np.ones(len(b.y))]) @ coefs[mine].T) > 0).sum(axis=0)
            out[0 if cls else 1, mine] += hit
            out[2 if cls else 3, mine] += len(b.y) - hit
        return out.ravel()
    return sum_arrays(blocks, count).reshape(4, len(fits)).T


def _ratio(a, b):
    return float(a / b) if b else 0.0


METRICS = {"accuracy": lambda tp, fp, fn, tn: _ratio(tp + tn, tp + fp + fn + tn), "f1": lambda tp, fp, fn, tn: _ratio(2 * tp, 2 * tp + fp + fn),
           "precision": lambda tp, fp, fn, tn: _ratio(tp, tp + fp), "recall": lambda tp, fp, fn, tn: _ratio(tp, tp + fn)}


def logistic_grid_search(train: DataFrame, test: DataFrame | None, grid, metric: str = "f1", fold_col: str = "fold", features="features",
                         label: str = "label", balanced: bool = False, name: str = "LogisticRegression", loss: str = "logistic",
                         blocks: DataFrame | None = None):
    """V10 for L1 (and, with ``loss='squared_hinge'``, for L2): (record as of ``search.grid_search``, DataFrame (candidate, fold, metrics, params), model of the best candidate).

    All candidates on all folds and on all rows are one batch of Newton fits;
    one more aggregate counts the held-out confusions. The best mean
    ``metric`` (of METRICS) wins, ties go to the first candidate. ``blocks``:
    the packed ``train`` of a caller that searches it more than once (and
    releases it).
    """
    t0 = time.time()
    cands = as_candidates(grid)
    own = blocks is None
    if own:
        blocks = pack(train, features, label, None, fold_col)
    folds = sorted(int(r[0]) for r in train.select(fold_col).distinct().collect() if r[0] is not None)      # k values
    fits = [Fit(**{"balanced": balanced, "loss": loss, **c}, fold=f) for c in cands for f in (*folds, None)]
    models, jobs = fit_blocks(blocks, fits, features)
    left = [f for f in fits if f.fold is not None]
    rows = [(i // len(folds), f.fold, *[m(*map(float, c)) for m in METRICS.values()], candidate_id(cands[i // len(folds)]))
            for i, (f, c) in enumerate(zip(left, held_out_counts(blocks, left)))]
    if own:
        release(blocks)
    at = 2 + list(METRICS).index(metric)
    mean = [(-float(np.mean([r[at] for r in rows if r[0] == i])), i, float(np.std([r[at] for r in rows if r[0] == i]))) for i in range(len(cands))]
    best = min(mean)
    model = models[(best[1] + 1) * (len(folds) + 1) - 1]
    rec = {"model": name, "params": {k: str(v) for k, v in cands[best[1]].items()}, "status": "ok", "metric": metric,
           "cv_mean": -best[0], "cv_std": best[2]}
    if test is not None:
        rec.update(_test_metrics(model, test, label, "classification"))
    rec["time_min"] = (time.time() - t0) / 60.0
    rec["timestamp"] = datetime.now(timezone.utc).isoformat(timespec="seconds")
    table = train.sparkSession.createDataFrame(rows, "candidate int, fold int, " + ", ".join(f"{m} double" for m in METRICS) + ", params string")
    return rec, table, model
