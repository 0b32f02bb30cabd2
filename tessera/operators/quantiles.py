"""Exact quantiles (linear interpolation, as pandas ``median``/``quantile``
and SQL ``quantile_cont``) that stay distributed for hot groups.

Spark's built-in ``percentile``/``median`` keep a value->count map per group
inside one task; a group holding a third of the table would hold a third of
the distinct values in one task's memory. Here the same answer comes from:

1. counts per (group, value)          -- partial aggregation, skew-safe;
2. running counts per group in value order (``order.running_sum``),
   split into approximate-quantile ranges;
3. pick the rows that cover ranks floor/ceil((n-1)q) and interpolate, one
   ``groupBy(group)`` for all requested probabilities.

``approx=True`` switches to ``percentile_approx`` (one pass, bounded memory).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .order import join_null_safe, running_sum


def _qname(q: float) -> str:
    return "q" + str(q).replace(".", "_").replace("-", "m")


def _picked(counts: DataFrame, part: list, probs, names) -> DataFrame:
    """Quantiles per ``part`` of a table of counts (``part``, ``_v``, ``_c``)."""
    cum = running_sum(counts, "_v", ["_c"], partition=part, totals=True)
    # 0-based rank r is covered by a value row when cum-c <= r < cum
    aggs = []
    for i, q in enumerate(probs):
        pos = (F.col("_c_tot") - 1) * F.lit(float(q))
        lo, hi = F.floor(pos), F.ceil(pos)
        start = F.col("_c_cum") - F.col("_c")
        cover_lo = (start <= lo) & (lo < F.col("_c_cum"))
        cover_hi = (start <= hi) & (hi < F.col("_c_cum"))
        aggs += [F.max(F.when(cover_lo, F.col("_v"))).alias(f"_lo{i}"),
                 F.max(F.when(cover_hi, F.col("_v"))).alias(f"_hi{i}"),
                 F.max(pos - lo).alias(f"_fr{i}")]
    picked = cum.groupBy(*part).agg(*aggs)
    return picked.select(*part, *[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_fr{i}")).alias(n)
        for i, n in enumerate(names)])


def group_quantiles(df: DataFrame, column: str, probs: list[float], groups=(),
                    approx: bool = False, names: list[str] | None = None,
                    with_global: bool = False) -> DataFrame:
    """One row per group with one column per probability (NULLs ignored;
    a group whose values are all NULL gets NULL). ``with_global`` adds a
    column ``_level`` (0 = group row, 1 = the single all-rows row) and
    computes both levels in the same pipeline: the global value counts are
    a roll-up of the (small) per-group count table, not a second scan."""
    groups = [groups] if isinstance(groups, str) else list(groups)
    names = names or [_qname(q) for q in probs]
    if approx:
        out = df.groupBy(*groups).agg(*[
            F.percentile_approx(column, q, 10000).cast("double").alias(n) for q, n in zip(probs, names)])
        if with_global:
            glob = df.agg(*[F.percentile_approx(column, q, 10000).cast("double").alias(n)
                            for q, n in zip(probs, names)])
            out = out.withColumn("_level", F.lit(0)).unionByName(glob.withColumn("_level", F.lit(1)),
                                                                allowMissingColumns=True)
        return out
    x = F.col(column).cast("double")
    # NULL/NaN values are counted under _v = NULL so that every group key
    # survives in the count table (an all-NULL group still gets a row)
    v = df.select(*groups, F.when(~F.isnan(x), x).alias("_v"))
    all_counts = cut_lineage(v.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_c")))
    counts = all_counts.where(F.col("_v").isNotNull())
    part = list(groups)
    if with_global:
        rolled = counts.groupBy("_v").agg(F.sum("_c").alias("_c"))
        counts = counts.withColumn("_level", F.lit(0)).unionByName(
            rolled.withColumn("_level", F.lit(1)), allowMissingColumns=True)
        part = ["_level", *groups]
    # the (group, value) count table is read several times below; it was
    # materialised once above (reliable checkpoint), not re-derived per use
    out = _picked(counts, part, probs, names)
    if groups:
        # groups whose values are all NULL still appear, with NULL quantiles
        keys = all_counts.select(*groups).distinct()
        if with_global:
            keys = keys.withColumn("_level", F.lit(0)).unionByName(
                df.sparkSession.range(1).select(F.lit(1).alias("_level")), allowMissingColumns=True)
        out = join_null_safe(keys, out, part, how="left")
    else:
        # a global quantile over an all-NULL column is one NULL row
        out = df.sparkSession.range(1).select(*[F.lit(None).cast("double").alias(n) for n in names]) \
            .unionByName(out.select(*names)).agg(*[F.max(n).alias(n) for n in names])
    return cut_lineage(out)  # the fitted table: small, read by every apply


def quantiles(df: DataFrame, columns: list[str], probs: list[float], approx: bool = False) -> DataFrame:
    """Exact quantiles of several columns -> one row with ``<col>_<qname>``
    columns. Columns are stacked into (name, value) first so every column
    shares one shuffle instead of one job per column."""
    names = [f"{c}__{_qname(q)}" for c in columns for q in probs]
    if not columns:
        return df.sparkSession.range(1).select()
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_x")) for c in columns
    ])).alias("_s")).select("_s._col", "_s._x")
    per = group_quantiles(long, "_x", probs, groups=["_col"], approx=approx)
    qcols = [_qname(q) for q in probs]
    wide = per.groupBy().agg(*[
        F.max(F.when(F.col("_col") == c, F.col(qc))).alias(f"{c}__{qc}")
        for c in columns for qc in qcols])
    return wide.select(*names)


def quantiles_leaving_out(df: DataFrame, columns: list[str], probs: list[float], fold_col: str, folds: list) -> list[dict]:
    """Per fold: the row of ``quantiles`` of the rows of every other fold, as a dict.

    One pass counts each value's rows, in all and per fold; the others' counts are differences."""
    long = df.where(F.col(fold_col).isNotNull()).select(F.col(fold_col).alias("_f"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in columns])).alias("_s")) \
        .select("_f", "_s.*").where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    counts = long.groupBy("_col", "_v").agg(F.count(F.lit(1)).alias("_n"), *[
        F.count_if(F.col("_f") == f).alias(f"_n{i}") for i, f in enumerate(folds)])
    left = F.explode(F.array(*[F.struct(F.lit(i).alias("_out"), (F.col("_n") - F.col(f"_n{i}")).alias("_c")) for i in range(len(folds))]))
    counts = counts.select("_col", "_v", left.alias("_s")).select("_col", "_v", "_s.*").where("_c > 0")
    names = [_qname(q) for q in probs]
    out = [{f"{c}__{n}": None for c in columns for n in names} for _ in folds]
    for r in _picked(counts, ["_out", "_col"], probs, names).collect():  # folds x columns rows
        out[r["_out"]].update({f"{r['_col']}__{n}": r[n] for n in names})
    return out


def median_of(df: DataFrame, columns: list[str], approx: bool = False) -> DataFrame:
    """One-row frame ``{col: median}``."""
    q = quantiles(df, columns, [0.5], approx=approx)
    return q.select(*[F.col(f"{c}__{_qname(0.5)}").alias(c) for c in columns])


__all__ = ["group_quantiles", "quantiles", "quantiles_leaving_out", "median_of"]
