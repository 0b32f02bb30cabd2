"""Scalar feature functions (F1-F11, C12): all built-in Column expressions,
no Python UDF, so they stay inside whole-stage codegen."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def derive(df: DataFrame, exprs: dict) -> DataFrame:
    """add/replace columns from expressions (Column or SQL text)."""
    return df.withColumns({k: (F.expr(v) if isinstance(v, str) else v) for k, v in exprs.items()})


def extract(col, pattern: str, group: int = 1) -> Column:
    """first match of ``pattern``; NULL when nothing matches (Spark's
    ``regexp_extract`` returns '' there)."""
    return F.nullif(F.regexp_extract(_c(col), pattern, group), F.lit(""))


def collapse_values(col, mapping: dict) -> Column:
    """many-to-one replacement, other values unchanged.
    ``mapping`` is {new_value: [old values]} or {old: new}."""
    c = _c(col)
    pairs = []
    for k, v in mapping.items():
        if isinstance(v, (list, tuple, set)):
            pairs += [(old, k) for old in v]
        else:
            pairs.append((k, v))
    expr = None
    for old, new in pairs:
        expr = (F.when(c == F.lit(old), F.lit(new)) if expr is None
                else expr.when(c == F.lit(old), F.lit(new)))
    return c if expr is None else expr.otherwise(c)


def map_values(col, mapping: dict, default=None) -> Column:
    """dictionary lookup; unmapped (and NULL) -> ``default`` (NULL if None)."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    looked = F.element_at(m, _c(col)) if mapping else F.lit(None)
    # element_at on a missing key is NULL outside ANSI; guard with map_contains_key
    looked = F.when(F.map_contains_key(m, _c(col)), looked)
    return looked if default is None else F.coalesce(looked, F.lit(default))


def flag_equals(col, value) -> Column:
    """1 if col == value else 0 (NULL -> 0)."""
    return F.when(_c(col) == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def cut(col, edges: list, labels: list | None = None, include_lowest: bool = True,
        default=None) -> Column:
    """right-closed bins ``(e[i], e[i+1]]`` with the lowest edge included
    when ``include_lowest``; out of range / NULL -> ``default``.
    (``ml.feature.Bucketizer`` is left-closed, so it is not used.)"""
    c = _c(col)
    labels = list(range(len(edges) - 1)) if labels is None else labels
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        lower_ok = (c >= F.lit(lo)) if (i == 0 and include_lowest) else (c > F.lit(lo))
        cond = lower_ok & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def log_target(col) -> Column:
    """log1p."""
    return F.log1p(_c(col))


def inv_log_target(col) -> Column:
    """expm1 (inverse of ``log_target``)."""
    return F.expm1(_c(col))


def apply_threshold(score, t: float) -> Column:
    """F8: (score >= t) as 0/1 int."""
    return (_c(score) >= F.lit(float(t))).cast("int")


def round_half_even(col, digits: int = 0) -> Column:
    """banker's rounding (0.5 -> 0, 1.5 -> 2); ``F.round`` is half-up."""
    return F.bround(_c(col), digits)


def clean_name(col) -> Column:
    """model/file-safe name: spaces and '/' -> '_'."""
    return F.translate(_c(col), " /", "__")


def presence_flag(col) -> Column:
    """1 when not NULL else 0."""
    return _c(col).isNotNull().cast("int")


def nonfinite_to_null(col) -> Column:
    """C10 core: NaN, +Inf and -Inf -> NULL."""
    c = _c(col).cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(c)


def minmax_score(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """(x - min) / (max - min) over the scored frame; max == min -> NULL.
    The min/max frame has one row: broadcast is a proven bound."""
    out = out or col
    stats = df.agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))
    return df.crossJoin(F.broadcast(stats)).withColumn(
        out, F.try_divide(F.col(col) - F.col("_mn"), F.col("_mx") - F.col("_mn"))
    ).drop("_mn", "_mx")
