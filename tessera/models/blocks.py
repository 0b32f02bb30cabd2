"""Numeric tables packed for iterative fits.

A block is one row of a written table: the features, label, weight and fold of
up to ``BLOCK`` rows as raw arrays. An iteration then hands a task a few binary
values instead of a row at a time, computes with numpy, and returns a fixed
number of sums, which Spark adds up (``sum_arrays``). Blocks are cut in the
task that reads the rows, so packing shuffles nothing; they lie in the
checkpoint folder, so a lost executor repeats only its tasks.

Rows with a null or non-finite feature, label or weight take no part; a null
fold is the number -1 (trains in every fold, held out in none).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, spread

BLOCK = 65_536
SCHEMA = "n int, x binary, y binary, w binary, fold binary"


@dataclass
class Block:
    x: np.ndarray
    y: np.ndarray
    w: np.ndarray
    fold: np.ndarray

    @classmethod
    def of(cls, batch, i: int, kind=np.float64) -> "Block":
        n = batch.column("n")[i].as_py()
        get = lambda c, t: np.frombuffer(batch.column(c)[i].as_buffer(), t)
        return cls(get("x", kind).reshape(n, -1), get("y", np.float64), get("w", np.float64), get("fold", np.int32))


def blocks_of(batches, kind=np.float64):
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block.of(batch, i, kind)


def _pack_batch(rows: int):
    import pyarrow as pa

    def one(parts):
        x, y, w, f = (np.concatenate([p[k] for p in parts]) for k in range(4))
        return pa.RecordBatch.from_arrays(
            [pa.array([len(y)], pa.int32())] + [pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in (x, y, w, f)],
            names=["n", "x", "y", "w", "fold"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            col = batch.column("x")
            lens = col.value_lengths().to_numpy(zero_copy_only=False)
            if not batch.num_rows:
                continue
            width = int(lens[0])
            if (lens != width).any():
                raise ValueError("feature vectors of different lengths")
            x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
            y, w = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("y", "w"))
            fold = batch.column("fold").to_numpy(zero_copy_only=False).astype(np.int32)
            ok = np.isfinite(x).all(axis=1) & np.isfinite(y) & np.isfinite(w)
            held.append((x[ok], y[ok], w[ok], fold[ok]))
            n += int(ok.sum())
            while n >= rows:
                parts = [np.concatenate([p[k] for p in held]) for k in range(4)]
                yield one([tuple(a[:rows] for a in parts)])
                held, n = [tuple(a[rows:] for a in parts)], n - rows
        if n:
            yield one(held)
    return run


def features_column(df: DataFrame, features) -> F.Column:
    """An array of doubles from a vector column or a list of column names."""
    if isinstance(features, str):
        return vector_to_array(features) if dict(df.dtypes)[features] == "vector" else F.col(features).cast("array<double>")
    return F.array(*[F.col(f"`{c}`").cast("double") for c in features])


def pack(df: DataFrame, features="features", label: str = "label", weight_col: str | None = None, fold_col: str | None = None,
         rows: int = BLOCK) -> DataFrame:
    """The written table of blocks (``SCHEMA``) of the complete rows."""
    src = df.select(features_column(df, features).alias("x"), F.col(f"`{label}`").cast("double").alias("y"),
                    (F.col(f"`{weight_col}`").cast("double") if weight_col else F.lit(1.0)).alias("w"),
                    (F.coalesce(F.col(f"`{fold_col}`").cast("int"), F.lit(-1)) if fold_col else F.lit(-1)).alias("fold"))
    return cut_lineage(spread(src).mapInArrow(_pack_batch(rows), SCHEMA))


#: numbers that the tasks of a sum may send to the driver one by one
TO_DRIVER = 100_000
#: numbers of a slice: the tasks' arrays are added slice by slice
SLICE = 16_384


def sum_arrays(blocks: DataFrame, work, kind=np.float64, size: int = 1) -> np.ndarray:
    """Sum over all blocks of ``work(Block) -> 1-d array`` (of one length); one array per task, added by Spark.

    ``size``: the length of the arrays, if it is large. Arrays of over
    ``TO_DRIVER`` numbers in all are cut into slices and added in a shuffle, so
    that one array reaches the driver, whatever the number of tasks.

    ``work`` is called in the tasks. No blocks give an empty array. A fit asks
    hundreds of times for a few numbers, so the packed blocks are kept (memory,
    then disk; from the checkpoint if an executor is lost) and a sum is one bare
    job: planning a query each time would take longer than the sum itself.
    """
    if not hasattr(blocks, "_packed"):
        blocks._packed = blocks.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
        blocks._tasks = blocks._packed.getNumPartitions()

    def run(rows):
        total = None
        for n, x, y, w, fold in rows:
            s = work(Block(np.frombuffer(x, kind).reshape(n, -1), np.frombuffer(y, np.float64), np.frombuffer(w, np.float64),
                           np.frombuffer(fold, np.int32)))
            total = s if total is None else total + s
        if total is not None:
            yield np.ascontiguousarray(total, np.float64)

    part = blocks._packed.mapPartitions(run)
    if blocks._tasks > 1 and (blocks._tasks > 64 or blocks._tasks * size > TO_DRIVER):
        slices = part.flatMap(lambda a: [(i, a[i:i + SLICE]) for i in range(0, len(a), SLICE)])
        found = dict(slices.reduceByKey(_add, min(blocks._tasks, max(1, -(-size // SLICE)))).collect())
        return np.concatenate([found[i] for i in sorted(found)]) if found else np.zeros(0)
    total = np.zeros(0)
    for s in part.collect():
        total = _add(total, s)
    return total


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return b.copy() if not len(a) else a if not len(b) else a + b


def release(blocks: DataFrame) -> None:
    """Forget the kept blocks."""
    if hasattr(blocks, "_packed"):
        blocks._packed.unpersist()
        del blocks._packed
