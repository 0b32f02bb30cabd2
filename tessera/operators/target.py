"""Target encoding out of fold, and pruning of correlated columns.

**Target encoding.** A level's value is its mean label, smoothed towards the
prior: (sum + smoothing * prior) / (n + smoothing). Training rows take sums
without their own fold's rows (level totals minus (level, fold) totals, prior
likewise), so a row's own label never reaches its features; other frames take
the totals. A level never seen outside the fold, or at all, gets the prior; null
is a level.

Sums are partial aggregates; the rows then meet a table of levels x folds. A
table of at most ``BROADCAST_ROWS`` rows is broadcast. Beyond, levels that hold
at least one row in ``HOT`` (at most ``HOT`` levels, so always small) are
broadcast and only the others are joined by shuffle: no task gets a hot level.

**Correlation pruning.** Columns are visited in the given order; one goes if
its |r| with a column kept before exceeds the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .order import BROADCAST_ROWS, join_null_safe

HOT = 1000


class TargetEncoding:
    """Sums of the label per level and fold; ``frame`` columns: _level, _fold, _s, _n."""

    def __init__(self, sums: DataFrame, column: str, label: str, fold_col: str | None, smoothing: float):
        self.sums, self.column, self.label, self.fold_col, self.smoothing = sums, column, label, fold_col, smoothing
        self.folds = {r["_fold"]: (float(r["s"] or 0.0), r["n"]) for r in
                      sums.groupBy("_fold").agg(F.sum("_s").alias("s"), F.sum("_n").alias("n")).collect()}      # k rows
        self.total = (sum(s for s, _ in self.folds.values()), sum(n for _, n in self.folds.values()))
        self.hot = max(self.total[1] // HOT, 1)

    def _prior(self, fold):
        s, n = self.folds.get(fold, (0.0, 0))
        rest = self.total[1] - n
        return (self.total[0] - s) / rest if rest else None

    def _meet(self, df: DataFrame, table: DataFrame, keys) -> DataFrame:
        """Left join of the rows with the table on ``keys`` (null-safe), split by hot levels if the table is large."""
        table = cut_lineage(table)
        if table.count() <= BROADCAST_ROWS:
            return join_null_safe(df, F.broadcast(table), keys, "left")
        hot = table.where(F.col("_all_n") >= self.hot)
        names = cut_lineage(hot.select(F.col("_level").alias("_hot_level")).distinct())
        marked = df.join(F.broadcast(names), F.col("_level").eqNullSafe(F.col("_hot_level")), "left_semi")
        rest = df.join(F.broadcast(names), F.col("_level").eqNullSafe(F.col("_hot_level")), "left_anti")
        return join_null_safe(marked, F.broadcast(hot), keys, "left").unionByName(
            join_null_safe(rest, table.where(F.col("_all_n") < self.hot), keys, "left"))

    def _levels(self) -> DataFrame:
        return self.sums.groupBy("_level").agg(F.sum("_s").alias("_all_s"), F.sum("_n").alias("_all_n"))

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        """Rows that were not trained on: the totals of their level."""
        j = self._meet(df.withColumn("_level", F.col(f"`{self.column}`")), self._levels(), ["_level"])
        prior = self.total[0] / self.total[1] if self.total[1] else None
        value = self._smooth(F.coalesce("_all_s", F.lit(0.0)), F.coalesce("_all_n", F.lit(0)), F.lit(prior).cast("double"))
        return j.withColumn(out or f"{self.column}_target", value).select(*[F.col(f"`{c}`") for c in df.columns if c != (out or f"{self.column}_target")],
                                                                          out or f"{self.column}_target")

    def transform_train(self, df: DataFrame, out: str | None = None) -> DataFrame:
        """Training rows: the totals of their level without their own fold; rows without a fold (or of one not trained on) take all of it."""
        name = out or f"{self.column}_target"
        kind, known = dict(self.sums.dtypes)["_fold"], [f for f in self.folds if f is not None]
        own = F.col(f"`{self.fold_col}`")
        j = df.withColumns({"_level": F.col(f"`{self.column}`"), "_fold": F.when(own.isin(known), own).cast(kind)})
        folds = F.explode(F.array(*[F.lit(f).cast(kind) for f in (*known, None)])).alias("_fold")      # every level meets every fold, and none
        every = self._levels().select("*", folds)
        table = join_null_safe(every, self.sums.where(F.col("_fold").isNotNull()), ["_level", "_fold"], "left")
        j = self._meet(j, table.withColumns({"_s": F.coalesce("_s", F.lit(0.0)), "_n": F.coalesce("_n", F.lit(0))}), ["_level", "_fold"])
        prior = F.lit(self.total[0] / self.total[1] if self.total[1] else None).cast("double")
        for f in self.folds:
            if f is not None:
                prior = F.when(F.col("_fold") == F.lit(f), F.lit(self._prior(f)).cast("double")).otherwise(prior)
        value = self._smooth(F.coalesce(F.col("_all_s") - F.col("_s"), F.lit(0.0)), F.coalesce(F.col("_all_n") - F.col("_n"), F.lit(0)), prior)
        return j.withColumn(name, value).select(*[F.col(f"`{c}`") for c in df.columns if c != name], name)

    def _smooth(self, s, n, prior):
        a = F.lit(float(self.smoothing))
        return F.when(n + a > 0, (s + a * prior) / (n + a)).otherwise(prior)


def fit_target_encoding(df: DataFrame, column: str, label: str, fold_col: str | None = None, smoothing: float = 10.0) -> TargetEncoding:
    """Sums per (level, fold), written once. Rows with a null or NaN label take no part."""
    y = F.col(f"`{label}`").cast("double")
    fold = F.col(f"`{fold_col}`") if fold_col else F.lit(None).cast("int")
    src = df.select(F.col(f"`{column}`").alias("_level"), fold.alias("_fold"), y.alias("_y")).where(F.col("_y").isNotNull() & ~F.isnan("_y"))
    sums = cut_lineage(src.groupBy("_level", "_fold").agg(F.sum("_y").alias("_s"), F.count(F.lit(1)).alias("_n")))
    return TargetEncoding(sums, column, label, fold_col, smoothing)


def prune_correlated(df: DataFrame, cols, threshold: float = 0.95) -> DataFrame:
    """(column, position, kept, because, r): the verdict on each column; ``because`` is the first kept column it repeats.

    One aggregate gives all correlations; columns x columns numbers reach the driver. A null
    correlation (constant column) never removes a column.
    """
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]

    def corr(a, b):                                              # over rows that have both; null where one of them is constant
        x, y = F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")
        spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
        return F.try_divide(F.covar_pop(x, y), spread)
    found = df.agg(*[corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]).first() if pairs else ()
    r = {}
    for (a, b), v in zip(pairs, found):
        r[a, b] = r[b, a] = None if v is None or v != v else v
    kept, rows = [], []
    for i, c in enumerate(cols):
        clash = next((k for k in kept if r[k, c] is not None and abs(r[k, c]) > threshold), None)
        rows.append((c, i, clash is None, clash, None if clash is None else float(r[clash, c])))
        if clash is None:
            kept.append(c)
    return df.sparkSession.createDataFrame(rows, "column string, position int, kept boolean, because string, r double")


def drop_correlated(df: DataFrame, cols, threshold: float = 0.95) -> DataFrame:
    """The frame without the columns that ``prune_correlated`` rejects."""
    gone = {r["column"] for r in prune_correlated(df, cols, threshold).collect() if not r["kept"]}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in gone])
