"""Exact k-nearest neighbours as a blocked join (L4).

Both sides are cut into blocks by a hash of their key; every (query block,
train block) cell is one cogroup task that computes distances with numpy
and emits only the k nearest train rows per query. A query therefore sees
``k x #train_blocks`` candidates (bounded by the block count, never all
pairs), merged with a per-query window. Block counts follow the data size
(``rows_per_block``), so no task holds more than a block of each side, and
nothing is collected to the driver. Predictions for a whole sweep of k
values come from the same neighbour table in one aggregate.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _vec(df: DataFrame, features) -> F.Column:
    if isinstance(features, str):
        return F.col(features).cast("array<double>")
    return F.array(*[F.col(c).cast("double") for c in features])


#: cells (query x train row) computed at a time: 16 MB of doubles, whatever the dimension
CHUNK_CELLS = 2_000_000
#: train rows and queries whose city-block distances are added up at a time: the sums stay in the processor's cache
TILE, TILE_QUERIES = 4_096, 16
#: bytes of a task's train block (vectors as doubles)
BLOCK_BYTES = 32 << 20
#: (query block, train block) cells per core at least
CELLS_PER_CORE = 3


def _cells(qx: np.ndarray, tx: np.ndarray, metric: str, p: float) -> np.ndarray:
    """Order-preserving distances of all cells; memory does not grow with the dimension."""
    if metric == "euclidean":  # |a - b|^2 = |a|^2 - 2ab + |b|^2, rounded
        return (qx * qx).sum(1)[:, None] - 2.0 * (qx @ tx.T) + (tx * tx).sum(1)[None, :]
    d = np.zeros((len(qx), len(tx)))
    for j in range(qx.shape[1]):
        d += np.abs(qx[:, j, None] - tx[None, :, j]) ** p
    return d


def _tiles(tx: np.ndarray) -> list:
    """The train vectors in single precision, TILE at a time, a row per component."""
    return [np.ascontiguousarray(tx[a:a + TILE].T.astype(np.float32)) for a in range(0, len(tx), TILE)]


def _city_block(qx: np.ndarray, tiles: list) -> np.ndarray:
    """City-block distances in single precision, tile by tile."""
    qx = qx.astype(np.float32)
    d, a = np.empty((len(qx), sum(t.shape[1] for t in tiles)), np.float32), 0
    for tile in tiles:
        for s in range(0, len(qx), TILE_QUERIES):
            some = qx[s:s + TILE_QUERIES]
            total, step = np.zeros((len(some), tile.shape[1]), np.float32), np.empty((len(some), tile.shape[1]), np.float32)
            for j in range(len(tile)):
                np.subtract(tile[j][None, :], some[:, j, None], out=step)
                np.abs(step, out=step)
                np.add(total, step, out=total)
            d[s:s + TILE_QUERIES, a:a + tile.shape[1]] = total
        a += tile.shape[1]
    return d


def _exact(qx: np.ndarray, tx: np.ndarray, metric: str, p: float) -> np.ndarray:
    """Distances of paired rows."""
    out = np.empty(len(qx))
    step = max(1, CHUNK_CELLS // max(1, qx.shape[1]))
    for s in range(0, len(qx), step):
        diff = qx[s:s + step] - tx[s:s + step]
        if metric == "euclidean":
            out[s:s + step] = np.sqrt((diff ** 2).sum(-1))
        elif metric == "manhattan":
            out[s:s + step] = np.abs(diff).sum(-1)
        else:  # minkowski
            out[s:s + step] = (np.abs(diff) ** p).sum(-1) ** (1.0 / p)
    return out


def _local_topk(k: int, metric: str, p: float):
    def fn(qpdf: pd.DataFrame, tpdf: pd.DataFrame) -> pd.DataFrame:
        names = ["_qk", "_tk", "_ty", "_dist"]
        if qpdf.empty or tpdf.empty:
            return pd.DataFrame({n: [] for n in names})
        tx = np.stack(tpdf["_tx"].to_numpy()).astype(np.float64)
        tk, ty = tpdf["_tk"].to_numpy(), tpdf["_ty"].to_numpy().astype(np.float64)
        order_of_key = np.empty(len(tk), np.int64)  # keys of any type, compared by rank
        order_of_key[np.argsort(tk, kind="stable")] = np.arange(len(tk))
        qx_all = np.stack(qpdf["_qx"].to_numpy()).astype(np.float64)
        qk_all = qpdf["_qk"].to_numpy()
        kk = min(k, len(tk))
        norm = float((tx * tx).sum(1).max(initial=0.0))
        step = max(1, CHUNK_CELLS // len(tk))
        # single precision ranks city-block distances if its rounding (of values, differences and sums) stays a small margin
        largest = max(np.abs(tx).max(initial=0.0), np.abs(qx_all).max(initial=0.0))
        single = metric == "manhattan" and np.isfinite(largest) and largest < 1e30
        tiles = _tiles(tx) if single else None
        rounding = float(largest) * tx.shape[1] * (tx.shape[1] + 8) * 2.0 ** -22
        outs = []
        for s in range(0, len(qk_all), step):
            qx = qx_all[s:s + step]
            d = _city_block(qx, tiles) if single else _cells(qx, tx, "minkowski" if metric == "manhattan" else metric, 1.0 if metric == "manhattan" else p)
            kth = np.partition(d, kk - 1, axis=1)[:, kk - 1]
            # rounding of the expanded square (or of the sum) must not lose a neighbour: keep a margin, then recompute
            slack = 1e-9 * (1.0 + np.abs(kth) + ((qx * qx).sum(1) + norm if metric == "euclidean" else 0.0))
            bound = np.nextafter((kth + rounding).astype(np.float32), np.float32(np.inf)) if single else kth + slack
            rows, cols = np.nonzero(d <= bound[:, None])
            dist = _exact(qx[rows], tx[cols], metric, p)
            # order by (distance, train key) so ties are deterministic
            by = np.lexsort((order_of_key[cols], dist, rows))
            rows, cols, dist = rows[by], cols[by], dist[by]
            first = np.searchsorted(rows, np.arange(len(qx)))
            take = np.arange(len(rows)) - first[rows] < kk
            rows, cols, dist = rows[take], cols[take], dist[take]
            outs.append(pd.DataFrame({"_qk": qk_all[s:s + step][rows], "_tk": tk[cols], "_ty": ty[cols], "_dist": dist}))
        return pd.concat(outs, ignore_index=True)
    return fn


def knn_neighbors(train: DataFrame, query: DataFrame, features, label: str, train_key: str, query_key: str,
                  k: int, metric: str = "euclidean", p: float = 2.0, rows_per_block: int | None = None,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_key, neighbor key, neighbor label, distance, rank) for the k
    nearest train rows of every query row (rank 1 = nearest; ties by key).

    Block counts: a train block holds at most ``block_bytes`` of vectors
    (so each query row is copied once per train block -- few copies, the
    communication cost of an exact answer; a task's memory is a few such
    blocks, whatever the tables' sizes); query blocks are sized the same
    way and raised until there are enough cells to keep every core busy.
    ``rows_per_block`` fixes both block sizes in rows instead."""
    tstat = train.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(_vec(train, features))).alias("d")).first()
    n_query = query.agg(F.count(F.lit(1))).first()[0]
    if rows_per_block:
        tb = max(1, math.ceil(tstat["n"] / rows_per_block))
        qb = max(1, math.ceil(n_query / rows_per_block))
    else:
        row_bytes = 8 * max(1, tstat["d"] or 1)
        tb = max(1, math.ceil(tstat["n"] * row_bytes / block_bytes))
        cores = train.sparkSession.sparkContext.defaultParallelism
        qb = max(1, math.ceil(n_query * row_bytes / block_bytes), math.ceil(CELLS_PER_CORE * cores / tb))
    t = train.select(F.col(train_key).alias("_tk"), F.col(label).cast("double").alias("_ty"),
                     _vec(train, features).alias("_tx")).withColumn("_tb", F.pmod(F.xxhash64("_tk"), F.lit(tb)))
    q = query.select(F.col(query_key).alias("_qk"), _vec(query, features).alias("_qx")) \
        .withColumn("_qb", F.pmod(F.xxhash64("_qk"), F.lit(qb)))
    t = t.withColumn("_qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(qb - 1).cast("long"))))
    q = q.withColumn("_tb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tb - 1).cast("long"))))
    schema = T.StructType([T.StructField("_qk", query.schema[query_key].dataType),
                           T.StructField("_tk", train.schema[train_key].dataType),
                           T.StructField("_ty", T.DoubleType()), T.StructField("_dist", T.DoubleType())])
    cand = q.groupBy("_qb", "_tb").cogroup(t.groupBy("_qb", "_tb")).applyInPandas(
        _local_topk(k, metric, p), schema)
    w = Window.partitionBy("_qk").orderBy("_dist", "_tk")  # <= k * train blocks rows per query
    return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        F.col("_qk").alias(query_key), F.col("_tk").alias("neighbor"), F.col("_ty").alias("neighbor_label"),
        F.col("_dist").alias("distance"), "rank")


def knn_predict(neighbors: DataFrame, query_key: str, k_values, weights: str = "uniform") -> DataFrame:
    """Predictions for every k in ``k_values`` from one neighbour table:
    (query_key, k, prediction, probability of class 1 when binary).
    ``weights='distance'``: vote weight 1/d; when some of the k neighbours
    are at distance 0 only those vote. Class ties -> smallest class."""
    if query_key == "k":
        raise ValueError("the query key may not be named 'k' (the k column of the sweep)")
    ks = sorted(set(int(k) for k in k_values))
    n = neighbors.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks]))).where(F.col("rank") <= F.col("k"))
    if weights == "distance":
        zero = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy(query_key, "k"))
        wt = F.when(zero == 1, (F.col("distance") == 0).cast("double")).otherwise(1.0 / F.col("distance"))
    else:
        wt = F.lit(1.0)
    n = n.withColumn("_w", wt)
    votes = n.groupBy(query_key, "k", "neighbor_label").agg(F.sum("_w").alias("_v"))
    tot = Window.partitionBy(query_key, "k")
    votes = votes.withColumn("_share", F.col("_v") / F.sum("_v").over(tot))
    best = votes.withColumn("_r", F.row_number().over(tot.orderBy(F.col("_v").desc(), F.col("neighbor_label"))))
    p1 = votes.where(F.col("neighbor_label") == 1).select(query_key, "k", F.col("_share").alias("probability"))
    out = best.where(F.col("_r") == 1).select(query_key, "k", F.col("neighbor_label").cast("int").alias("prediction"))
    return out.join(p1, on=[query_key, "k"], how="left").withColumn(
        "probability", F.coalesce(F.col("probability"), F.lit(0.0)))
