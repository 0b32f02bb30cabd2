"""Descriptive statistics.

Rule: many statistics = one aggregate (one scan, partial aggregation), then
reshape the single row; never one job per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .clean import group_transform  # noqa: F401  (A11 lives with the fills)
from .quantiles import group_quantiles, quantiles


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def describe(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """A1: per column count, mean, std (sample), min, q25, median, q75, max
    and std_pop (the fitted normal's sigma). Exact quartiles."""
    cols = _as_list(cols)
    mom = df.agg(*[x for c in cols for x in (
        F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"),
        F.stddev_samp(c).alias(f"{c}__std"), F.stddev_pop(c).alias(f"{c}__std_pop"),
        F.min(F.col(c).cast("double")).alias(f"{c}__min"), F.max(F.col(c).cast("double")).alias(f"{c}__max"))])
    qs = quantiles(df, cols, [0.25, 0.5, 0.75], approx=approx)
    row = mom.crossJoin(qs)  # one row x one row
    fields = [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
              ("q25", "q0_25"), ("median", "q0_5"), ("q75", "q0_75"), ("max", "max"),
              ("std_pop", "std_pop")]
    stacked = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"),
        *[F.col(f"{c}__{src}").cast("long" if name == "count" else "double").alias(name)
          for name, src in fields]) for c in cols]))
    return row.select(stacked.alias("_s")).select("_s.*")


def count_by(df: DataFrame, keys) -> DataFrame:
    """A2: rows per key combination."""
    return df.groupBy(*_as_list(keys)).agg(F.count(F.lit(1)).alias("n"))


def rate_by(df: DataFrame, keys, target: str, z: float = 1.96) -> DataFrame:
    """A3: mean of a 0/1 target per group with a normal-approximation
    interval (stands in for the plot's bootstrap error bars)."""
    g = df.groupBy(*_as_list(keys)).agg(F.count(F.lit(1)).alias("n"),
                                        F.avg(F.col(target).cast("double")).alias("rate"))
    half = F.lit(z) * F.sqrt(F.col("rate") * (1 - F.col("rate")) / F.col("n"))
    return g.withColumn("ci_low", F.greatest(F.col("rate") - half, F.lit(0.0))) \
        .withColumn("ci_high", F.least(F.col("rate") + half, F.lit(1.0)))


def _binned(df: DataFrame, col: str, bins: int):
    rng = df.agg(F.min(F.col(col).cast("double")).alias("_lo"),
                 F.max(F.col(col).cast("double")).alias("_hi"))
    d = df.where(F.col(col).isNotNull()).crossJoin(F.broadcast(rng))  # one row
    w = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(w == 0, F.lit(0)).otherwise(
        F.least(F.lit(bins - 1), F.floor((F.col(col) - F.col("_lo")) / w)))
    return d.withColumn("bin", b.cast("int")).withColumn("_w", w)


def histogram(df: DataFrame, col: str, bins: int = 10, by=()) -> DataFrame:
    """A4: equal-width bins over [min, max] (the max falls in the last bin,
    like numpy); counts per (by..., bin) with bin edges. Empty bins are
    absent."""
    by = _as_list(by)
    d = _binned(df, col, bins)
    return d.groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.first(F.col("_lo") + F.col("bin") * F.col("_w")).alias("lower"),
        F.first(F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("upper"))


def density(df: DataFrame, col: str, by, bins: int = 20) -> DataFrame:
    """Per group, histogram normalised to integrate to 1
    (count / (group rows * bin width)); width 0 -> share."""
    by = _as_list(by)
    h = histogram(df, col, bins, by)
    tot = F.sum("n").over(Window.partitionBy(*by))  # rows per group <= bins
    width = F.col("upper") - F.col("lower")
    return h.withColumn("density", F.when(width > 0, F.col("n") / (tot * width)).otherwise(F.col("n") / tot))


def box_stats(df: DataFrame, value: str, keys) -> DataFrame:
    """A5: per group exact quartiles, whiskers at the most extreme values
    within 1.5 IQR of the box, and the outlier count."""
    keys = _as_list(keys)
    q = group_quantiles(df, value, [0.25, 0.5, 0.75], groups=keys, names=["q1", "median", "q3"])
    d = df.select(*keys, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    d = d.join(q, on=keys, how="inner") if keys else d.crossJoin(F.broadcast(q))  # ungrouped: one row
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    inside = (F.col("_x") >= lo_f) & (F.col("_x") <= hi_f)
    return d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))


def corr_matrix(df: DataFrame, cols) -> DataFrame:
    """Pearson r for every pair a <= b (by position), pairwise-complete
    (a row counts for a pair when both are non-null). One aggregate with all
    pairs, then unpivot."""
    cols = _as_list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_r{i}")
                   for i, (a, b) in enumerate(pairs)])
    stacked = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                                           F.col(f"_r{i}").alias("r")) for i, (a, b) in enumerate(pairs)]))
    return row.select(stacked.alias("_s")).select("_s.a", "_s.b", "_s.r")


def top_correlated(df: DataFrame, target: str, cols, k: int = 10):
    """The k columns (target included, r = 1) with the largest signed
    correlation with ``target``; returns (ranking, sub-matrix of those)."""
    cols = [c for c in _as_list(cols) if c != target]
    row = df.agg(F.lit(1.0).alias(target), *[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c)
                                              for c in cols])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("r"))
                                  for c in [target] + cols]))
    ranked = row.select(stacked.alias("_s")).select("_s.*").where(F.col("r").isNotNull())
    top = ranked.orderBy(F.col("r").desc(), F.col("column")).limit(k)
    chosen = [r["column"] for r in top.collect()]  # k names: bounded
    return top, corr_matrix(df, chosen)


def class_balance(df: DataFrame, col: str) -> DataFrame:
    """Count and percent per predicted class."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("percent", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))


def score_summary(df: DataFrame, keys, score: str) -> DataFrame:
    """A10: mean and population std (numpy ddof=0) of scores per key, and
    the 2-sigma band width the reference prints."""
    g = df.groupBy(*_as_list(keys)).agg(F.count(F.lit(1)).alias("n"),
                                        F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"))
    return g.withColumn("two_std", 2 * F.col("std"))
