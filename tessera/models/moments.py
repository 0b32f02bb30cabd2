"""Linear regression from sufficient statistics: one scan serves every fold and every penalty (V8, V10 with L9-L11).

``fold_moments`` sums, per fold, the products of (1, features, label): that is
all a least-squares fit with any penalty needs. The training set of a fold is
the total minus the fold, so k folds cost one aggregate; every candidate is
then solved on d x d matrices, and the held-out error follows from the held-out
fold's own sums. Nothing but folds x (d + 2)^2 / 2 sums reaches the driver.

Penalties follow the reference's conventions: ridge ``|y - Xw|^2 + alpha |w|^2``,
lasso and elastic net ``|y - Xw|^2 / 2n + alpha (r |w|_1 + (1 - r) |w|^2 / 2)``;
the intercept is never penalised.

Rows with a null or non-finite feature or label take no part; rows with a null
fold are in every training set and in no held-out one; a fold without training
rows, or without rows, has null metrics.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import StateModel
from .search import as_candidates, candidate_id

#: with more features the products are summed as matrices in Arrow batches, not as columns
COLUMN_SUMS = 24


@dataclass
class Moments:
    """Sums over rows: n, s = sum z, q = sum z z' with z = (features, label)."""
    n: float
    s: np.ndarray
    q: np.ndarray

    def __add__(self, o):
        return Moments(self.n + o.n, self.s + o.s, self.q + o.q)

    def __sub__(self, o):
        return Moments(self.n - o.n, self.s - o.s, self.q - o.q)

    def centred(self):
        """(means of x, mean of y, centred X'X, centred X'y)."""
        m = self.s / self.n
        c = self.q - self.n * np.outer(m, m)
        return m[:-1], m[-1], c[:-1, :-1], c[:-1, -1]

    def sse(self, w: np.ndarray, b: float) -> float:
        """Sum of squared errors of the line on these rows."""
        v = np.append(-w, 1.0)
        return max(float(v @ self.q @ v - 2 * b * (v @ self.s) + self.n * b * b), 0.0)


def _clean(df: DataFrame, cols, label: str) -> DataFrame:
    ok = None
    for c in [*cols, label]:
        x = F.col(f"`{c}`").cast("double")
        fine = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
        ok = fine if ok is None else ok & fine
    return df.where(ok)


def _matrix_batch(d: int):
    import pyarrow as pa

    def run(batches):
        total: dict = {}
        for batch in batches:
            z = np.column_stack([np.ones(batch.num_rows)] + [batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, d + 1)])
            fold = np.array(batch.column(0).to_pylist(), object)
            for f in set(fold.tolist()):
                zf = z[[x == f for x in fold.tolist()]] if len(set(fold.tolist())) > 1 else z
                total[f] = total.get(f, 0) + zf.T @ zf
        for f, m in total.items():
            at = np.flatnonzero(np.triu(np.ones((d + 1, d + 1), bool)).ravel())
            yield pa.RecordBatch.from_arrays([pa.array([f] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(m.ravel()[at])],
                                             names=["fold", "at", "v"])
    return run


def fold_moments(df: DataFrame, cols, label: str, fold_col: str | None = None, clean: bool = True) -> dict:
    """{fold: Moments}, one aggregate; folds as text for more than COLUMN_SUMS columns. Without ``fold_col`` one entry, None.
    ``clean=False``: the caller's rows are complete and finite."""
    cols, d = list(cols), len(cols) + 1
    z = [F.col(f"`{c}`").cast("double") for c in (*cols, label)]
    fold = F.col(f"`{fold_col}`") if fold_col else F.lit(None).cast("int")
    src = (_clean(df, cols, label) if clean else df).select(fold.alias("fold"), *[x.alias(f"z{i}") for i, x in enumerate(z)])
    out = {}
    if len(cols) <= COLUMN_SUMS:
        pairs = [(i, j) for i in range(d) for j in range(i, d)]
        sums = [F.sum(f"z{i}").alias(f"s{i}") for i in range(d)] + [F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"q{i}_{j}") for i, j in pairs]
        for r in src.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *sums).collect():     # one row per fold
            q = np.zeros((d, d))
            for i, j in pairs:
                q[i, j] = q[j, i] = r[f"q{i}_{j}"]
            out[r["fold"]] = Moments(float(r["n"]), np.array([r[f"s{i}"] for i in range(d)]), q)
        return out
    part = src.withColumn("fold", F.col("fold").cast("string")).mapInArrow(_matrix_batch(d), "fold string, at int, v double")
    raw: dict = {}
    for r in part.groupBy("fold", "at").agg(F.sum("v").alias("v")).collect():                # folds x (d + 1)^2 / 2 sums
        raw.setdefault(r["fold"], np.zeros((d + 1) ** 2))[r["at"]] = r["v"]
    for f, m in raw.items():
        m = m.reshape(d + 1, d + 1)
        m = m + np.triu(m, 1).T
        out[f] = Moments(m[0, 0], m[0, 1:], m[1:, 1:])
    return out


# --- solvers on d x d matrices ----------------------------------------------

def solve_ridge(m: Moments, alpha: float = 1.0, fit_intercept: bool = True):
    """(w, b) of L9."""
    mx, my, g, c = m.centred() if fit_intercept else (np.zeros(len(m.s) - 1), 0.0, m.q[:-1, :-1], m.q[:-1, -1])
    a = g + alpha * np.eye(len(c))
    try:
        w = np.linalg.solve(a, c)
    except np.linalg.LinAlgError:                              # alpha 0 with dependent columns: the shortest solution
        w = np.linalg.lstsq(a, c, rcond=None)[0]
    return w, float(my - mx @ w)


def solve_elastic_net(m: Moments, alpha: float = 1.0, l1_ratio: float = 0.5, fit_intercept: bool = True,
                      tol: float = 1e-13, max_iter: int = 100_000, start: np.ndarray | None = None):
    """(w, b) of L10 (``l1_ratio`` 1) and L11 by cyclic coordinate descent on X'X / n and X'y / n."""
    mx, my, g, c = m.centred() if fit_intercept else (np.zeros(len(m.s) - 1), 0.0, m.q[:-1, :-1], m.q[:-1, -1])
    g, c = g / m.n, c / m.n
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    w = np.zeros(len(c)) if start is None else start.copy()
    for _ in range(max_iter):
        moved = 0.0
        for j in range(len(c)):
            if g[j, j] <= 0:
                continue                                       # a constant column has no coefficient
            r = c[j] - g[j] @ w + g[j, j] * w[j]
            new = math.copysign(max(abs(r) - l1, 0.0), r) / (g[j, j] + l2)
            moved = max(moved, abs(new - w[j]) * math.sqrt(g[j, j]))
            w[j] = new
        if moved <= tol:
            break
    return w, float(my - mx @ w)


def solve_lasso(m: Moments, alpha: float = 1.0, **options):
    return solve_elastic_net(m, alpha, 1.0, **options)


SOLVERS = {"ridge": solve_ridge, "lasso": solve_lasso, "elastic_net": solve_elastic_net}


class MomentsModel(StateModel):
    """A linear model as a projection: intercept + sum of coefficient x column."""

    def __init__(self, cols=None, coefficients=None, intercept: float = 0.0, prediction: str = "prediction"):
        super().__init__(None if cols is None else {"cols": list(cols), "coefficients": [float(x) for x in coefficients],
                                                    "intercept": float(intercept), "prediction": prediction})

    @property
    def coefficients(self):
        return self.learned["coefficients"]

    @property
    def intercept(self):
        return self.learned["intercept"]

    def _transform(self, df: DataFrame) -> DataFrame:
        a = self.learned
        y = F.lit(a["intercept"])
        for c, w in zip(a["cols"], a["coefficients"]):
            y = y + F.lit(w) * F.col(f"`{c}`")
        return df.withColumn(a["prediction"], y)


def fit_moments(df: DataFrame, cols, label: str = "label", kind: str = "ridge", **params) -> MomentsModel:
    """L9-L11 on plain columns from one aggregate."""
    m = sum(fold_moments(df, cols, label).values(), Moments(0.0, np.zeros(len(cols) + 1), np.zeros((len(cols) + 1,) * 2)))
    if not m.n:
        raise ValueError("no complete rows to fit on")
    return MomentsModel(cols, *SOLVERS[kind](m, **params))


class FoldFit:
    """``fit(df, features=..., label=..., **params)`` of L9 or L10, which ``search.cross_validate`` runs for all folds and candidates from one aggregate.

    Called with a frame it is that fit. ``fold_lines`` gives the lines that the
    fit finds without each fold: the same least-squares problem, solved on the
    folds' sums (``kind`` as in SOLVERS). A null or non-finite value is an
    error, as in the fit.
    """

    def __init__(self, fit, kind: str, features: str = "features", label: str = "label", **fixed):
        self.fit, self.kind, self.features, self.label, self.fixed = fit, kind, features, label, fixed

    def __call__(self, df: DataFrame, **params):
        return self.fit(df, features=self.features, label=self.label, **{**self.fixed, **params})

    def solve(self, m: Moments, params: dict):
        if m.n <= 0:
            raise ValueError("no rows to fit on")
        return SOLVERS[self.kind](m, **{**self.fixed, **params})

    def fold_lines(self, df: DataFrame, fold_col: str, candidates):
        """(columns x, {(candidate, fold): (w, b)}), the line of a fold's held-out rows; None with too many features for one aggregate."""
        from .blocks import features_column
        x = features_column(df, self.features)
        width = df.select(F.size(x)).first()
        if width is None or not 0 < width[0] <= COLUMN_SUMS:
            return None
        # the array is made once a row, not once in every sum
        at = lambda a: [F.get(a, F.lit(i)) for i in range(width[0])]
        folds = strict_moments(df.select(fold_col, self.label, x.alias("_inputs")), at(F.col("_inputs")), self.label, fold_col)
        total = sum_of(folds)
        return at(x), {(i, f): self.solve(total - folds[f], c) for i, c in enumerate(candidates) for f in folds}


def sum_of(folds: dict) -> Moments:
    ms = list(folds.values())
    return sum(ms[1:], ms[0])


def strict_moments(df: DataFrame, inputs, label: str, fold_col: str) -> dict:
    """``fold_moments`` of column expressions, folds in order; a null or non-finite value is an error."""
    def sure(x):
        x = x.cast("double")
        bad = x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
        return F.when(bad, F.raise_error(F.lit("null or non-finite value in a fit")).cast("double")).otherwise(x)
    names = [f"_x{i}" for i in range(len(inputs))]
    src = df.select(F.col(f"`{fold_col}`").alias("_fold"), sure(F.col(f"`{label}`")).alias("_y"), *[sure(x).alias(n) for x, n in zip(inputs, names)])
    found = fold_moments(src, names, "_y", "_fold", clean=False)  # a filter on them would compute the inputs anew in each condition
    return {f: found[f] for f in sorted(found)}


def rescaled(m: Moments, mid, width) -> Moments:
    """The sums of ((x - mid) / width, y) from those of (x, y)."""
    c, w = np.append(mid, 0.0), np.append(width, 1.0)
    q = m.q - np.outer(c, m.s) - np.outer(m.s, c) + m.n * np.outer(c, c)
    return Moments(m.n, (m.s - m.n * c) / w, q / np.outer(w, w))


# --- cross-validation -------------------------------------------------------

def cross_validate_moments(folds: dict, candidates, kind: str = "ridge") -> list[dict]:
    """Rows (candidate, fold, n, rmse, r2) of every candidate on every fold, from the folds' sums."""
    total = sum(list(folds.values())[1:], list(folds.values())[0]) if folds else None
    out = []
    for f in sorted((f for f in folds if f is not None)):
        held, train = folds[f], total - folds[f]
        for i, params in enumerate(candidates):
            row = {"candidate": i, "fold": f, "n": int(held.n), "rmse": None, "r2": None}
            if train.n > 0 and held.n > 0:
                sse = held.sse(*SOLVERS[kind](train, **params))
                spread = held.q[-1, -1] - held.s[-1] ** 2 / held.n
                row["rmse"] = math.sqrt(sse / held.n)
                row["r2"] = float(1 - sse / spread) if spread > 0 else None
            out.append(row)
    return out


def linear_grid_search(train: DataFrame, test: DataFrame | None, cols, grid, *, kind: str = "ridge", label: str = "label",
                       fold_col: str = "fold", name: str = "model"):
    """V10 for L9-L11: (record as of ``search.grid_search``, DataFrame (candidate, fold, n, rmse, r2, params), refit model).

    One aggregate over ``train`` gives all folds, all candidates and the refit;
    the best mean RMSE wins, ties go to the first candidate.
    """
    t0 = time.time()
    cands = as_candidates(grid)
    folds = fold_moments(train, cols, label, fold_col)
    rows = cross_validate_moments(folds, cands, kind)
    score = []
    for i in range(len(cands)):
        e = [r["rmse"] for r in rows if r["candidate"] == i and r["rmse"] is not None]
        score.append((math.inf if not e else float(np.mean(e)), i, float(np.std(e)) if e else 0.0))
    best = min(score)
    params = cands[best[1]]
    model = MomentsModel(cols, *SOLVERS[kind](sum(list(folds.values())[1:], list(folds.values())[0]), **params))
    rec = {"model": name, "params": {k: str(v) for k, v in params.items()}, "status": "ok", "metric": "rmse",
           "cv_mean": None if math.isinf(best[0]) else best[0], "cv_std": best[2]}
    if test is not None:
        held = sum(fold_moments(test, cols, label).values(), Moments(0.0, np.zeros(len(cols) + 1), np.zeros((len(cols) + 1,) * 2)))
        rec["test_rmse"] = math.sqrt(held.sse(np.array(model.coefficients), model.intercept) / held.n) if held.n else None
    rec["time_min"] = (time.time() - t0) / 60.0
    rec["timestamp"] = datetime.now(timezone.utc).isoformat(timespec="seconds")
    fold_type = dict(train.dtypes)[fold_col] if len(cols) <= COLUMN_SUMS else "string"
    table = train.sparkSession.createDataFrame(
        [(r["candidate"], r["fold"], r["n"], r["rmse"], r["r2"], candidate_id(cands[r["candidate"]])) for r in rows],
        f"candidate int, fold {fold_type}, n long, rmse double, r2 double, params string")
    return rec, table, model
