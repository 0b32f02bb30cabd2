"""Encoding, scaling, vectors.

Fitted state is a small DataFrame (vocabulary, one-row statistics) learned
from ``fit_on`` and applied to any frame, so train and test always share a
vocabulary and scale (the reference's separately-encoded test set is not
reproducible here by design).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..models.base import StateModel
from ..session import cut_lineage
from .order import global_position
from .quantiles import quantiles, quantiles_leaving_out


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def vocabularies(df: DataFrame, cols, max_size: int = 10000) -> dict:
    """Sorted distinct non-null values of every column, from ONE query over
    the stacked (column, value) pairs. The result becomes output column
    names (one-hot), so it is bounded: more than ``max_size`` values in a
    column raises instead of silently producing a huge schema."""
    cols = _as_list(cols)
    pairs = _stacked(df, cols).distinct()
    sizes = {r[0]: r[1] for r in pairs.groupBy("_col").agg(F.count(F.lit(1))).collect()}  # one row per column
    big = [c for c, n in sizes.items() if n > max_size]
    if big:
        raise ValueError(f"{big}: more than {max_size} categories as columns; use one_hot_vector or label_encode")
    out = {c: [] for c in cols}
    for r in pairs.collect():  # bounded: <= max_size values per column
        out[r["_col"]].append(r["_val"])
    for c in cols:
        t = df.schema[c].dataType
        out[c] = sorted(_back(v, t) for v in out[c])
    return out


def _stacked(df: DataFrame, cols) -> DataFrame:
    """(``_col``, ``_val`` as text) for every non-null cell of ``cols``."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("_col"), F.col(c).cast("string").alias("_val")) for c in cols])).alias("_s")) \
        .select("_s._col", "_s._val").where(F.col("_val").isNotNull())


def _back(v, dtype):
    from pyspark.sql import types as T
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return int(v)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return float(v)
    return v


def vocabulary(df: DataFrame, col: str, max_size: int = 10000) -> list:
    return vocabularies(df, [col], max_size)[col]


def one_hot(df: DataFrame, cols, prefix: dict | str | None = None, fit_on: DataFrame | None = None,
            drop: bool = True, sep: str = "_") -> DataFrame:
    """One 0/1 int column per category of ``fit_on`` (sorted), named
    ``<prefix><sep><value>``; NULL and unseen values -> all zeros."""
    cols = _as_list(cols)
    src = fit_on if fit_on is not None else df
    vocab = vocabularies(src, cols)
    new = {}
    for c in cols:
        p = prefix.get(c, c) if isinstance(prefix, dict) else (prefix or c)
        for v in vocab[c]:
            new[f"{p}{sep}{v}"] = F.when(F.col(c) == F.lit(v), F.lit(1)).otherwise(F.lit(0))
    out = df.withColumns(new)
    return out.drop(*cols) if drop else out


def one_hot_vector(df: DataFrame, col: str, out: str | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """E1 for vocabularies of any size: a sparse 0/1 vector column instead of
    one column per category (position = code of ``label_encode``); NULL and
    unseen values -> all zeros. Nothing but the vocabulary's size reaches the
    driver."""
    from pyspark.ml.feature import OneHotEncoder
    src = fit_on if fit_on is not None else df
    codes = fit_codes(src, [col])
    n = codes.count()
    key = codes.select(F.col("_val").alias("_ohv"), F.col("_code").alias("_ohc"))
    j = df.withColumn("_ohk", F.col(col).cast("string")).join(key, F.col("_ohk") == F.col("_ohv"), "left")
    j = j.withColumn("_ohc", F.coalesce("_ohc", F.lit(n)).cast("double"))   # the extra last code is dropped: all zeros
    sizes = df.sparkSession.range(n + 1).select(F.col("id").cast("double").alias("_ohc"))
    enc = OneHotEncoder(inputCol="_ohc", outputCol=out or f"{col}_onehot", dropLast=True).fit(sizes)
    return enc.transform(j).drop("_ohk", "_ohv", "_ohc")


def fit_codes(fit_on: DataFrame, cols, null_as: str | None = None) -> DataFrame:
    """Vocabulary table (``_col``, ``_val``, ``_code``) for all ``cols`` at
    once, codes 0..n-1 in ascending value order per column. Distinct
    (column, value) pairs are numbered by ``global_position`` (range
    partitions + broadcast offsets), then shifted by each column's first
    position -- never through one task or the driver. The table is
    checkpointed: every column's apply-join reads it."""
    cols = _as_list(cols)
    src = fit_on
    if null_as is not None:
        src = fit_on.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(null_as)) for c in cols})
    # keep the native order of numeric columns: order by the typed value
    typed = src.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("_col"), F.col(c).cast("string").alias("_val"),
                 (F.col(c).cast("double") if _is_numeric(src, c) else F.lit(None).cast("double")).alias("_num"))
        for c in cols])).alias("_s")).select("_s.*").where(F.col("_val").isNotNull()).distinct()
    pos = global_position(typed, ["_col", "_num", "_val"], out="_pos")
    first = pos.groupBy("_col").agg(F.min("_pos").alias("_first"))  # one row per column
    codes = pos.join(F.broadcast(first), on="_col").select(
        "_col", "_val", (F.col("_pos") - F.col("_first")).cast("int").alias("_code"))
    return cut_lineage(codes)


def _is_numeric(df: DataFrame, c: str) -> bool:
    from .columns import NUMERIC_TYPES
    return isinstance(df.schema[c].dataType, NUMERIC_TYPES)


def label_encode(df: DataFrame, cols, fit_on: DataFrame | None = None, null_as: str | None = None,
                 keep_unseen: bool = False) -> DataFrame:
    """Category -> code (``int``) in sorted order of the vocabulary of
    ``fit_on`` (e.g. train unioned with test, as the reference does).
    ``null_as='nan'`` encodes NULL like ``astype(str)`` does before fitting.
    Values absent from the vocabulary -> NULL (or -1 with ``keep_unseen``).
    One fit pipeline for all columns; one lookup join per column against
    the small checkpointed code table (AQE broadcasts it)."""
    cols = _as_list(cols)
    src = fit_on if fit_on is not None else df
    codes = fit_codes(src, cols, null_as)
    out = df
    for c in cols:
        cc = codes.where(F.col("_col") == c).select(F.col("_val").alias(f"_v_{c}"), F.col("_code"))
        key = F.col(c).cast("string")
        if null_as is not None:
            key = F.coalesce(key, F.lit(null_as))
        out = out.withColumn(f"_k_{c}", key).join(cc, F.col(f"_k_{c}") == F.col(f"_v_{c}"), "left")
        code = F.col("_code") if not keep_unseen else F.coalesce(F.col("_code"), F.lit(-1))
        out = out.withColumn(c, code.cast("int")).drop("_code", f"_k_{c}", f"_v_{c}")
    return out.select(*df.columns)


def fit_standard(fit_on: DataFrame, cols, ddof: int = 0) -> DataFrame:
    """One row: ``<c>__mean``, ``<c>__std`` (population std by default, like
    sklearn; ``ml.StandardScaler`` would use the sample std)."""
    std = F.stddev_pop if ddof == 0 else F.stddev_samp
    return fit_on.agg(*[x for c in _as_list(cols) for x in (
        F.avg(c).alias(f"{c}__mean"), std(c).alias(f"{c}__std"))])


def standard_scale(df: DataFrame, cols, fit_on: DataFrame | None = None, ddof: int = 0,
                   stats: DataFrame | None = None) -> DataFrame:
    """(x - mean) / std with statistics of ``fit_on``; std 0 -> 1."""
    cols = _as_list(cols)
    stats = stats if stats is not None else fit_standard(fit_on if fit_on is not None else df, cols, ddof)
    out = df.crossJoin(F.broadcast(stats))  # one row
    scaled = {}
    for c in cols:
        sd = F.col(f"{c}__std")
        scaled[c] = (F.col(c) - F.col(f"{c}__mean")) / F.when((sd == 0) | sd.isNull(), F.lit(1.0)).otherwise(sd)
    return out.withColumns(scaled).select(*df.columns)


def fit_robust(fit_on: DataFrame, cols, approx: bool = False) -> DataFrame:
    return quantiles(fit_on, _as_list(cols), [0.25, 0.5, 0.75], approx=approx)


def robust_scale(df: DataFrame, cols, fit_on: DataFrame | None = None, approx: bool = False,
                 stats: DataFrame | None = None) -> DataFrame:
    """(x - median) / (q75 - q25) with exact quartiles of ``fit_on`` (or
    ``stats``, fitted before); IQR 0 -> 1. (``ml.RobustScaler`` uses approximate quantiles.)"""
    cols = _as_list(cols)
    stats = stats if stats is not None else fit_robust(fit_on if fit_on is not None else df, cols, approx)
    out = df.crossJoin(F.broadcast(stats))  # one row
    scaled = {}
    for c in cols:
        iqr = F.col(f"{c}__q0_75") - F.col(f"{c}__q0_25")
        scaled[c] = (F.col(c) - F.col(f"{c}__q0_5")) / F.when((iqr == 0) | iqr.isNull(), F.lit(1.0)).otherwise(iqr)
    return out.withColumns(scaled).select(*df.columns)


def assemble(df: DataFrame, cols, out: str = "features", handle_invalid: str = "error") -> DataFrame:
    """E5: numeric columns -> one ``vector`` column."""
    return VectorAssembler(inputCols=_as_list(cols), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def pipeline(stages) -> Pipeline:
    """A ``pyspark.ml`` Pipeline (scaler + model fitted together, so
    cross-validation refits the scaler inside every fold)."""
    return Pipeline(stages=list(stages))


class ScaledModel(StateModel):
    """A model fitted on scaled features together with the scaling fitted on
    the same rows (E6): ``transform`` scales with the stored statistics,
    assembles and predicts. Statistics, columns and model are one saved unit."""

    def __init__(self, model=None, stats: dict | None = None, cols=(), how: str = "standard", features: str = "features"):
        super().__init__(None if stats is None else {"stats": stats, "cols": list(cols), "how": how, "features": features},
                         [model] if model is not None else ())

    @property
    def model(self):
        return self.parts[0]

    @staticmethod
    def centre(s: dict, c: str, how: str):
        """(middle, width) of a column."""
        return (s[f"{c}__mean"], s[f"{c}__std"]) if how == "standard" else \
            (s[f"{c}__q0_5"], None if s[f"{c}__q0_75"] is None else s[f"{c}__q0_75"] - s[f"{c}__q0_25"])

    def prepare(self, df: DataFrame) -> DataFrame:
        a = self.learned
        base = df.drop(a["features"]) if a["features"] in df.columns else df
        s, scaled = a["stats"], {}
        for c in a["cols"]:  # the statistics are literals: no join in the plan of a fit
            mid, width = self.centre(s, c, a["how"])
            scaled[c] = (F.col(c) - F.lit(mid).cast("double")) / F.lit(width or 1.0)
        return assemble(base.withColumns(scaled), a["cols"], a["features"])

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.prepare(df))


def with_scaling(fit, cols, how: str = "standard", features: str = "features"):
    """Wrap ``fit(df, **params)`` so that the scaler is fitted on the
    rows the model is fitted on (inside every CV fold), like a
    scaler + model pipeline. ``how``: 'standard' (population std) or
    'robust' (exact quartiles). If ``fit`` is a ``moments.FoldFit``, all folds'
    scalers come from one pass and so do their fits."""
    cols = _as_list(cols)

    def wrapped(df: DataFrame, **params):
        base = df.drop(features) if features in df.columns else df
        stats = (fit_standard(base, cols) if how == "standard" else fit_robust(base, cols)).first().asDict()
        prepared = ScaledModel(None, stats, cols, how, features).prepare(base)
        return ScaledModel(fit(prepared, **params), stats, cols, how, features)

    def fold_lines(df: DataFrame, fold_col: str, candidates):
        from ..models import moments
        if len(cols) > moments.COLUMN_SUMS:
            return None
        inputs = [F.col(f"`{c}`").cast("double") for c in cols]
        folds = moments.strict_moments(df, inputs, fit.label, fold_col)
        if how == "standard":
            r = df.agg(*[x.alias(f"{i}:{c}__{n}") for i, f in enumerate(folds) for c in cols for n, x in (
                ("mean", F.avg(F.when(F.col(fold_col) != f, F.col(f"`{c}`")))), ("std", F.stddev_pop(F.when(F.col(fold_col) != f, F.col(f"`{c}`")))))]).first()
            stats = [{k.split(":", 1)[1]: v for k, v in r.asDict().items() if k.startswith(f"{i}:")} for i in range(len(folds))]
        else:
            stats = quantiles_leaving_out(df, cols, [0.25, 0.5, 0.75], fold_col, list(folds))
        total, lines = moments.sum_of(folds), {}
        for f, s in zip(folds, stats):
            train = total - folds[f]
            if train.n <= 0:
                raise ValueError("no rows to fit on")
            mid, width = zip(*[ScaledModel.centre(s, c, how) for c in cols])
            mid, width = [float(x) for x in mid], [float(x or 1.0) for x in width]
            scaled = moments.rescaled(train, mid, width)
            for i, params in enumerate(candidates):
                w, b = fit.solve(scaled, params)
                raw = [x / y for x, y in zip(w, width)]
                lines[i, f] = (raw, b - sum(x * m for x, m in zip(raw, mid)))
        return inputs, lines

    if hasattr(fit, "fold_lines"):
        wrapped.fold_lines = fold_lines
    return wrapped
