"""Null, outlier and value cleaning.

Statistics are *fitted* on one frame (``fit_on``, default: the frame itself)
and *applied* to another, so "fit on train, apply to test" and the leaky
"fit on train + test" variants are the same call. A fitted statistic is a
one-row DataFrame; applying it is a cross join with that broadcast row (a
proven size bound of one row) followed by ``coalesce``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import nonfinite_to_null
from .columns import NUMERIC_TYPES
from .order import join_null_safe, range_split
from .quantiles import group_quantiles, median_of


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def _null_cond(df: DataFrame, c: str):
    col = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)  # pandas counts NaN as missing
    return col.isNull()


def present(df: DataFrame, c: str):
    """The cell, NULL where it counts as missing (NULL, and NaN of a float column)."""
    return F.when(~_null_cond(df, c), F.col(f"`{c}`"))


# ---------------------------------------------------------------- profiling
def missing_profile(df: DataFrame, cols=None) -> DataFrame:
    """(column, total, percent) with percent = nulls / rows; one scan."""
    cols = list(cols or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(_null_cond(df, c)).alias(f"_m{i}") for i, c in enumerate(cols)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("total")) for i, c in enumerate(cols)]))
    return row.select("_rows", stacked.alias("_s")).select(
        "_s.column", "_s.total",
        (F.col("_s.total") / F.col("_rows")).alias("percent"))


def null_total(df: DataFrame, cols=None) -> DataFrame:
    """C11: total missing cells and the worst column's count (one row)."""
    prof = missing_profile(df, cols)
    return prof.agg(F.sum("total").cast("long").alias("null_total"),
                    F.max("total").alias("null_max"))


def nonfinite_report(df: DataFrame, cols=None) -> DataFrame:
    """C10 report: counts of NULL/NaN cells and of +-Inf cells over numeric columns."""
    cols = list(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)])
    nan = [F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))) for c in cols]
    inf = [F.count_if(F.abs(F.col(c).cast("double")) == F.lit(float("inf"))) for c in cols]
    zero = F.lit(0).cast("long")
    return df.agg(reduce(lambda a, b: a + b, nan, zero).alias("nan_count"),
                  reduce(lambda a, b: a + b, inf, zero).alias("inf_count"))


# ---------------------------------------------------------------- dropping
def sparse_columns(df: DataFrame, max_nulls: int | None = None, max_share: float | None = None,
                   cols=None) -> list[str]:
    """Columns whose missing count > max_nulls, or share > max_share
    (one aggregate; the decision is a list of names)."""
    prof = missing_profile(df, cols)
    cond = F.lit(False)
    if max_nulls is not None:
        cond = cond | (F.col("total") > max_nulls)
    if max_share is not None:
        cond = cond | (F.col("percent") > max_share)
    return [r["column"] for r in prof.where(cond).select("column").collect()]


def drop_sparse_columns(train: DataFrame, others=(), max_nulls=None, max_share=None, protect=()):
    """The train frame decides which columns go; the same columns go
    from every other frame. Returns (train, [others...])."""
    drop = [c for c in sparse_columns(train, max_nulls, max_share) if c not in set(protect)]
    return train.drop(*drop), [o.drop(*[c for c in drop if c in o.columns]) for o in others]


# ---------------------------------------------------------------- filling
def fill_literal(df: DataFrame, values: dict) -> DataFrame:
    """C4: missing -> literal per column (value cast to the column's type)."""
    return df.withColumns({
        c: F.coalesce(present(df, c), F.lit(v).cast(df.schema[c].dataType)) for c, v in values.items()})


def _apply_row(df: DataFrame, stats: DataFrame, cols) -> DataFrame:
    """coalesce(col, stat) using a one-row stats frame."""
    ren = stats.select(*[F.col(c).alias(f"_fill_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(ren))
    return out.withColumns({
        c: F.coalesce(present(df, c), F.col(f"_fill_{c}").cast(df.schema[c].dataType)) for c in cols
    }).drop(*[f"_fill_{c}" for c in cols])


def mode_of(df: DataFrame, cols) -> DataFrame:
    """Most frequent non-null value per column; ties -> smallest value.
    Counts per (column, value) (partial aggregation, skew-safe), then one
    arg-max per column. One row, original column types."""
    cols = _as_list(cols)
    parts = []
    for kind, ctype in (("s", "string"), ("d", "double")):
        these = [c for c in cols if (ctype == "string") == isinstance(df.schema[c].dataType, T.StringType)]
        if not these:
            continue
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("_col"), present(df, c).cast(ctype).alias("_v")) for c in these])).alias("_s")
        ).select("_s._col", "_s._v").where(F.col("_v").isNotNull())
        counts = long.groupBy("_col", "_v").agg(F.count(F.lit(1)).alias("_n"))
        best = counts.groupBy("_col").agg(F.min(F.struct((-F.col("_n")).alias("k"), F.col("_v").alias("v"))).alias("_b"))
        parts.append(best.groupBy().agg(*[
            F.max(F.when(F.col("_col") == c, F.col("_b.v"))).cast(df.schema[c].dataType).alias(c)
            for c in these]))
    return reduce(lambda a, b: a.crossJoin(b), parts)


def fit_stat(df: DataFrame, cols, how: str, approx: bool = False) -> DataFrame:
    """One-row frame with the fill statistic of each column."""
    cols = _as_list(cols)
    if how == "mean":
        return df.agg(*[F.avg(present(df, c)).alias(c) for c in cols])
    if how == "median":
        return median_of(df, cols, approx=approx)
    if how == "mode":
        return mode_of(df, cols)
    raise ValueError(how)


def fill_stat(df: DataFrame, cols, how: str = "mean", fit_on: DataFrame | None = None,
              approx: bool = False) -> DataFrame:
    """NULL -> mean | exact median | mode of ``fit_on`` (default df)."""
    cols = _as_list(cols)
    stats = fit_stat(fit_on if fit_on is not None else df, cols, how, approx)
    return _apply_row(df, stats, cols)


def fill_group_median(df: DataFrame, col: str, group, fallback: bool = True,
                      fit_on: DataFrame | None = None, approx: bool = False) -> DataFrame:
    """NULL -> median of the row's group; if the group has no value (or
    the key is NULL) -> the global median when ``fallback``.

    Group and global medians come out of one quantile pipeline; the group
    table (#groups rows) is joined on the key -- AQE broadcasts it when
    small and splits a hot key's partition otherwise; the global median is
    one row (broadcast)."""
    group = _as_list(group)
    src = fit_on if fit_on is not None else df
    med = group_quantiles(src, col, [0.5], groups=group, approx=approx, names=["_gmed"], with_global=fallback)
    if fallback:
        glob = med.where(F.col("_level") == 1).select(F.col("_gmed").alias("_glob"))
        med = med.where(F.col("_level") == 0).drop("_level")
    # the NULL-key group is never joined: pandas leaves it to the fallback
    out = df.join(med, on=group, how="left")
    filled = F.coalesce(present(df, col), F.col("_gmed"))
    if fallback:
        out = out.crossJoin(F.broadcast(glob))  # one row
        filled = F.coalesce(filled, F.col("_glob"))
    return out.withColumn(col, filled.cast(df.schema[col].dataType)).select(*df.columns)


def group_transform(df: DataFrame, col: str, group, agg: str = "mean", out: str | None = None) -> DataFrame:
    """Aggregate of the row's group broadcast to each row. Aggregated
    with groupBy (partial aggregation) and joined back, rather than a window
    that would sort a hot group inside one task."""
    group = _as_list(group)
    out = out or f"{col}_{agg}"
    fn = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count,
          "std": F.stddev_samp}[agg]
    if agg == "median":
        stats = group_quantiles(df, col, [0.5], groups=group, names=[out])
    else:
        stats = df.groupBy(*group).agg(fn(col).alias(out))
    return df.join(stats, on=group, how="left")


def forward_fill(df: DataFrame, cols, order_by, partition_by=(), partitions: int | None = None) -> DataFrame:
    """Missing -> last present earlier value in ``order_by`` (any orderable
    types; within ``partition_by``, where NULL is a key like any other).
    Skew-safe: rows are cut into ranges of (partition, order); each range is
    filled locally, and the last value of earlier ranges is carried in from a
    small (#groups x #ranges) table."""
    cols, order_by, parts = _as_list(cols), _as_list(order_by), _as_list(partition_by)
    d = range_split(df, [F.col(c) for c in (*parts, *order_by)], partitions=partitions, out="_seg")
    local = Window.partitionBy(*parts, "_seg").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({f"_loc_{c}": F.last(present(df, c), ignorenulls=True).over(local) for c in cols})
    seg_last = d.groupBy(*parts, "_seg").agg(*[
        F.max_by(F.col(c), F.when(present(df, c).isNotNull(), F.col("_mid"))).alias(f"_sl_{c}") for c in cols])
    before = Window.partitionBy(*parts).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carry = seg_last.select(*parts, "_seg", *[
        F.last(f"_sl_{c}", ignorenulls=True).over(before).alias(f"_cy_{c}") for c in cols])
    d = join_null_safe(d, carry, [*parts, "_seg"], how="left")
    d = d.withColumns({c: F.coalesce(F.col(f"_loc_{c}"), F.col(f"_cy_{c}"), F.col(f"`{c}`")) for c in cols})
    return d.select(*df.columns)


def clean_nonfinite(df: DataFrame, cols, fit_on: DataFrame | None = None, fill: str | None = "median") -> DataFrame:
    """NaN / +-Inf -> NULL, then (optionally) NULL -> median of ``fit_on``
    (whose non-finite values are also ignored)."""
    cols = _as_list(cols)
    clean = df.withColumns({c: nonfinite_to_null(c) for c in cols})
    if fill is None:
        return clean
    src = clean if fit_on is None else fit_on.withColumns({c: nonfinite_to_null(c) for c in cols})
    return fill_stat(clean, cols, fill, fit_on=src)


def top_k(df: DataFrame, col: str, k: int, tiebreak=()) -> DataFrame:
    """K rows with the largest ``col`` (outlier candidates)."""
    return df.orderBy(F.col(col).desc(), *_as_list(tiebreak)).limit(k)


def presence(df: DataFrame, col: str, out: str) -> DataFrame:
    """C12 as a frame transform."""
    return df.withColumn(out, F.col(col).isNotNull().cast("int"))
