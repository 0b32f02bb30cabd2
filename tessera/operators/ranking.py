"""Sort, leaderboard, arg-max, baseline comparison.

These run on *result* tables: one row per fitted model or candidate (at
most a few thousand rows), so an ordered window over the whole table is
acceptable here and nowhere else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order(metric: str, descending: bool, name: str | None):
    m = F.col(metric).desc_nulls_last() if descending else F.col(metric).asc_nulls_last()
    return [m] + ([F.col(name)] if name else [])


def sort(df: DataFrame, keys, descending: bool = False, tiebreak=()) -> DataFrame:
    """Explicit, total order (a tie-break key makes it repeatable)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = [F.col(k).desc() if descending else F.col(k) for k in keys]
    tb = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    return df.orderBy(*cols, *tb)


def leaderboard(results: DataFrame, metric: str, descending: bool = True, k: int | None = None,
                name: str = "model", out: str = "position") -> DataFrame:
    """Number results from 1 by metric (ties by name); keep the top k."""
    w = Window.orderBy(*_order(metric, descending, name))
    ranked = results.withColumn(out, F.row_number().over(w))
    return ranked.where(F.col(out) <= k) if k else ranked


def best(results: DataFrame, metric: str, descending: bool = True, name: str = "model") -> DataFrame:
    """The arg-max row (ties -> smallest name), selected by value, never
    by a position computed on a differently ordered list."""
    return results.orderBy(*_order(metric, descending, name)).limit(1)


def compare_to_baseline(results: DataFrame, baseline: DataFrame, metric: str = "test_f1",
                        name: str = "model", baseline_metric: str | None = None) -> DataFrame:
    """Join each result to its model's baseline: difference and a
    better / worse / same verdict; no baseline -> NULLs."""
    bm = baseline_metric or metric
    b = baseline.select(F.col(name), F.col(bm).alias("baseline"))
    out = results.join(b, on=name, how="left")
    diff = F.col(metric) - F.col("baseline")
    verdict = F.when(F.col("baseline").isNull(), F.lit(None).cast("string")) \
        .when(diff > 0, "better").when(diff < 0, "worse").otherwise("same")
    return out.withColumn("improvement", diff).withColumn("verdict", verdict)


def rank_candidates(cv: DataFrame, metric: str = "mean_score", out: str = "rank") -> DataFrame:
    """Rank by mean CV score, ties share the lowest rank (1, 1, 3)."""
    return cv.withColumn(out, F.rank().over(Window.orderBy(F.col(metric).desc_nulls_last())))
