"""Rows of a large table counted per cell of their binned features, for Spark's tree learners.

A tree learner sees a feature only through its bins (``max_bins``, as Spark's
own: thresholds from a sample of ``SAMPLE`` rows, by Spark's rule), so rows of
one class in the same bins are one row with their number as weight. ``counted``
writes these cells once: every row takes part, the counts are exact, and what
the learner then reads again and again is the cells. A regression label is
replaced by the cell's mean: the gain of a split and the value of a leaf depend
on sums of labels only, the spread inside a cell being in no split's power. It is
kept as SPREAD (squared deviations from the mean), for the errors of predictions.

With many features there are as many cells as rows and nothing is won, so
tables of over ``MAX_FEATURES`` features, and tables small enough for the
learner as they are (``COMPACT_ROWS``), are fitted row by row.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .base import StateModel
from .blocks import features_column

COMPACT_ROWS = 200_000
MAX_FEATURES = 8
#: rows from which thresholds are drawn (as in Spark's learners)
SAMPLE = 10_000
#: rows counted together in a task
CHUNK = 1_000_000
#: cells of one task
CELLS_PER_TASK = 16_000
#: partitions in which cells are drawn for bagging, fixed so that draws repeat on any cluster
DRAWS = 16
BINS, CODE, ROWS, SPREAD = "_bins", "_code", "_rows", "_spread"


def thresholds(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Thresholds between distinct values: all if they fit, else those nearest to equal shares of the sample."""
    v, n = np.unique(values, return_counts=True)
    if len(v) <= max_bins:
        return (v[:-1] + v[1:]) / 2
    stride = len(values) / max_bins
    out, target, seen = [], stride, n[0]
    for i in range(1, len(v)):
        if abs(seen - target) < abs(seen + n[i] - target):
            out.append((v[i - 1] + v[i]) / 2)
            target += stride
        seen += n[i]
    return np.array(out[:max_bins - 1])


def is_counted(df: DataFrame) -> bool:
    return ROWS in df.columns and BINS in df.columns


def bin_thresholds(df: DataFrame, features, rows: int, max_bins: int = 32, seed: int = 42) -> list[list[float]] | None:
    """Thresholds per feature; None with too many features for cells."""
    sample = df if rows <= SAMPLE else df.sample(fraction=min(1.0, 1.5 * SAMPLE / rows), seed=seed)
    first = df.select(F.size(features_column(df, features))).first()
    if first is None or not 0 < (first[0] or 0) <= MAX_FEATURES:
        return None
    x = np.array([r[0] for r in sample.select(features_column(df, features)).collect()], np.float64)  # about SAMPLE rows
    return [thresholds(c[np.isfinite(c)], max_bins).tolist() if np.isfinite(c).any() else [] for c in x.T]


def _bin(e: list, x) -> F.Column:
    return F.size(F.filter(F.lit(e), lambda t: t < x)).cast("double") if e else F.lit(0.0)


def bins_vector(x, edges) -> F.Column:
    """The bins (thresholds below the value) of an array column, as a vector."""
    return array_to_vector(F.array(*[_bin(list(e), F.get(x, F.lit(i))) for i, e in enumerate(edges)]))


def count_cells(df: DataFrame, features, label: str, edges, keep=(), regression: bool = False) -> DataFrame:
    """Cells of ``edges``: BINS, CODE, ``label``, ``keep`` and ROWS (a double, the number of rows); for a regression also SPREAD."""
    import pyarrow as pa
    import pyarrow.compute as pc

    widths, keys = [len(e) + 1 for e in edges], [CODE, *([] if regression else [label]), *keep]
    cuts = [np.array(e) for e in edges]
    label_type = T.DoubleType() if regression else df.schema[label].dataType
    fields = [T.StructField(CODE, T.LongType()), T.StructField(label, label_type), *[df.schema[k] for k in keep]]
    fields += [T.StructField(SPREAD, T.DoubleType())] if regression else []
    schema = T.StructType([*fields, T.StructField(ROWS, T.LongType())])

    def summed(held):
        sums = [(ROWS, "sum")] + ([(label, "sum"), (SPREAD, "sum")] if regression else [])
        t = pa.concat_tables(held).group_by(keys, use_threads=False).aggregate(sums)
        t = t.rename_columns([c.removesuffix("_sum") if c != f"{ROWS}_sum" else ROWS for c in t.column_names])
        return t.select([f.name for f in schema.fields]).combine_chunks().to_batches()

    def run(batches):
        held, rows = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            code = np.zeros(b.num_rows, np.int64)
            for i, cut in enumerate(cuts):
                code = code * widths[i] + np.searchsorted(cut, x[:, i], "left")
            cols = {CODE: pa.array(code), ROWS: pa.array(np.ones(b.num_rows, np.int64)), **{c: b.column(c) for c in (label, *keep)}}
            if regression:                                      # squares until the cell's mean is known
                cols[SPREAD] = pc.multiply(b.column(label), b.column(label))
            held.append(pa.table(cols))
            rows += b.num_rows
            if rows >= CHUNK:
                yield from summed(held)
                held, rows = [], 0
        if held:
            yield from summed(held)

    src = df.select(features_column(df, features).alias("_x"), F.col(label).cast(label_type).alias(label), *keep)
    agg = [F.sum(ROWS).cast("double").alias(ROWS)]
    if regression:
        agg += [(F.sum(label) / F.sum(ROWS)).alias(label), F.greatest(F.sum(SPREAD) - F.sum(label) * F.sum(label) / F.sum(ROWS), F.lit(0.0)).alias(SPREAD)]
    g = src.mapInArrow(run, schema).groupBy(*keys).agg(*agg)
    stride, digits = 1, []
    for w in reversed(widths):
        digits.insert(0, (F.floor(F.col(CODE) / F.lit(stride)) % w).cast("double"))
        stride *= w
    return _dealt(cut_lineage(g.select(array_to_vector(F.array(*digits)).alias(BINS), CODE, label, *keep, ROWS, *([SPREAD] if regression else []))))


def merged(frame: DataFrame, label: str) -> DataFrame:
    """Cells of a regression counted by fold: one row per cell, whatever its folds."""
    mean = F.sum(F.col(label) * F.col(ROWS)) / F.sum(ROWS)
    return _dealt(cut_lineage(frame.groupBy(CODE, BINS).agg(mean.alias(label), F.sum(ROWS).alias(ROWS)).select(BINS, CODE, label, ROWS)))


def _dealt(frame: DataFrame) -> DataFrame:
    """The written cells over as many tasks as they need."""
    tasks = max(1, -(-frame.count() // CELLS_PER_TASK))
    return frame if frame.rdd.getNumPartitions() == tasks else cut_lineage(frame.repartition(tasks))


class BinnedModel(StateModel):
    """A model of bins applied to raw features: bins them, predicts."""

    def __init__(self, edges=None, features="features", model=None):
        super().__init__(None if edges is None else {"edges": [list(e) for e in edges], "features": features}, [model] if model is not None else ())

    @property
    def model(self):
        return self.parts[0]

    @property
    def featureImportances(self):
        return self.model.featureImportances

    def _transform(self, df: DataFrame) -> DataFrame:
        a = self.learned
        held = df.withColumn("_x_of_bins", features_column(df, a["features"]))     # the array is made once a row, not once per feature
        return self.model.transform(held.withColumn(BINS, bins_vector(F.col("_x_of_bins"), a["edges"])).drop("_x_of_bins")).drop(BINS)


class Cells:
    """The cells of a table: ``frame``, and the thresholds if it was a table of rows."""

    def __init__(self, frame: DataFrame, edges=None, features="features"):
        self.frame, self.edges, self.features = frame, edges, features

    def model(self, fitted):
        return fitted if self.edges is None else BinnedModel(self.edges, self.features, fitted)

    @property
    def rows(self) -> int:
        return round(self.frame.agg(F.sum(ROWS)).first()[0])


def of(df: DataFrame, features, label: str, regression: bool = False, max_bins: int = 32, keep=()) -> Cells | None:
    """The cells of a large table, or of a table already counted; None if its rows are to be fitted."""
    if is_counted(df):
        return Cells(df)
    rows = df.count()
    edges = bin_thresholds(df, features, rows, max_bins) if rows > COMPACT_ROWS else None
    return None if edges is None else Cells(count_cells(df, features, label, edges, keep, regression), edges, features)


def counted(train: DataFrame, test: DataFrame | None = None, features="features", label: str = "label", keep=(), max_bins: int = 32):
    """(cells of train, cells of test, name of their weight), by thresholds of the training rows; small tables as they are, without a weight."""
    rows = train.count()
    edges = bin_thresholds(train, features, rows, max_bins) if rows > COMPACT_ROWS else None
    if edges is None:
        return train, test, None
    return count_cells(train, features, label, edges, keep), None if test is None else count_cells(test, features, label, edges), ROWS


def repeated(frame: DataFrame, least: int, weight: str = ROWS) -> DataFrame:
    """Cells split into up to ``least`` rows (all but one stand for one row each): a node then holds ``least`` rows if and only if its cells count as many."""
    if least <= 1:
        return frame
    parts = F.least(F.round(weight), F.lit(least)).cast("int")
    return frame.withColumn("_parts", parts).withColumn("_part", F.explode(F.sequence(F.lit(1), F.col("_parts")))) \
        .withColumn(weight, F.when(F.col("_part") > 1, F.lit(1.0)).otherwise(F.col(weight) - F.col("_parts") + 1)).drop("_parts", "_part")


def bagged(frame: DataFrame, label: str, n: int, seed: int) -> DataFrame:
    """Cells with ``_bag``: how often each of ``n`` bootstrap samples drew the cell's rows (a sum of one Poisson draw per row)."""
    import pyarrow as pa

    rows = frame.groupBy(CODE, BINS, label).agg(F.sum(ROWS).alias(ROWS)) \
        .repartition(DRAWS, CODE).sortWithinPartitions(CODE, label).select(CODE, label, ROWS, F.col(BINS))

    def run(batches):
        from pyspark import TaskContext
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for b in batches:
            lam = b.column(ROWS).to_numpy(zero_copy_only=False)
            draws = rng.poisson(lam[:, None], (b.num_rows, n)).astype(np.float64)
            bag = pa.ListArray.from_arrays(pa.array(np.arange(0, b.num_rows * n + 1, n, dtype=np.int32)), pa.array(draws.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("_x"), b.column(label), bag], names=["_x", label, "_bag"])

    from pyspark.ml.functions import vector_to_array
    drawn = rows.select(vector_to_array(BINS).alias("_x"), label, ROWS).mapInArrow(
        run, T.StructType([T.StructField("_x", T.ArrayType(T.DoubleType())), frame.schema[label], T.StructField("_bag", T.ArrayType(T.DoubleType()))]))
    return _dealt(cut_lineage(drawn.select(array_to_vector("_x").alias(BINS), label, "_bag")))
