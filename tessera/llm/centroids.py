"""Centroid clustering (Lloyd's rounds in exact integers) over subvector dictionaries.

Every vector is cut into blocks of ``block`` dimensions. A chunk of vectors
(one row of a written table, ``CHUNK`` vectors at most) holds, per block, the
distinct subvectors it has and each vector's code: a lossless dictionary. A
round computes the exact squared distance of each distinct subvector to each
centroid's block once, and a vector's distance is the sum of its codes'
partial distances. The sums of the new centroids come from the dictionaries
too: how often a cluster uses a code, times the subvector.

The chunks are encoded in the task that reads the vectors, without a shuffle;
a round is one aggregate that returns centroids x dimensions sums to the
driver, whatever the number of vectors. Chunks lie in the checkpoint folder,
so a lost executor only repeats its tasks of the current round.

Components are floor(scale * x) as integers of any size: chunks beyond
``SAFE`` compute with Python integers, and sums travel in decimal limbs.

Defined results: vectors of another length, null, or with null or non-finite
components take no part and are not returned; a null id hashes like an empty
one; repeated rows (and repeated ids) are vectors of their own, ties between
equal hashes go to the smaller vector; with fewer than ``k`` vectors each is a
centroid; an empty table gives no rows; a distance or inertia beyond 64 bits
is null.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialise

#: vectors of a chunk
CHUNK = 16_384
#: components up to here are summed and squared in 64 bits: 2 * (2 * SAFE)**2 * 64 dimensions < 2**63
SAFE = 1 << 27
#: sums travel as limbs of so many decimal digits
LIMB = 18
LONG = 1 << 63


def scaled(x: float, scale: int) -> int:
    """floor(scale * x) of a finite x, exact also where scale * x overflows a double."""
    return int(x) * scale if abs(x) >= 2.0 ** 53 else math.floor(scale * x)


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): int64 where all results are within SAFE, else Python integers."""
    if not values.size or np.abs(values).max() <= SAFE / scale - 1:
        return np.floor(scale * values).astype(np.int64)
    return np.array([scaled(float(x), scale) for x in values.ravel()], dtype=object).reshape(values.shape)


def vectors_of(batch, dims: int):
    """(ids, finite vectors of ``dims`` components) of a batch with columns _id, _v."""
    import pyarrow.compute as pc
    v = batch.column("_v")
    keep = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(v), dims), False).to_numpy(zero_copy_only=False))
    flat = pc.list_flatten(v.take(keep))
    x = flat.cast("double").to_numpy(zero_copy_only=False).reshape(-1, dims)          # nulls become NaN
    ok = np.isfinite(x).all(axis=1) if len(x) else np.zeros(0, bool)
    return batch.column("_id").take(keep[ok]), x[ok]


# --- dictionaries -----------------------------------------------------------

def encode_block(sub: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, code of each row), lossless."""
    if sub.dtype == object:
        index: dict = {}
        codes = np.array([index.setdefault(tuple(r), len(index)) for r in sub.tolist()], np.int32)
        out = np.empty((len(index), sub.shape[1]), object)
        for r, i in index.items():
            out[i] = r
        return out, codes
    raw = np.ascontiguousarray(sub.astype(np.int32))
    _, first, codes = np.unique(raw.view([("", np.int32)] * raw.shape[1]).ravel(), return_index=True, return_inverse=True)
    return sub[first], codes.astype(np.int32).ravel()


class Chunk:
    """Codes and dictionaries of the vectors of one chunk."""

    def __init__(self, dicts: list[np.ndarray], codes: np.ndarray):
        self.dicts, self.codes = dicts, codes

    @classmethod
    def of(cls, x: np.ndarray, block: int) -> "Chunk":
        parts = [encode_block(x[:, b:b + block]) for b in range(0, x.shape[1], block)]
        return cls([d for d, _ in parts], np.stack([c for _, c in parts]) if parts else np.zeros((0, len(x)), np.int32))

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """(vectors, centroids) squared distances: partial distances per distinct subvector, summed by code."""
        total, at = 0, 0
        for d, c in zip(self.dicts, self.codes):
            cen = centroids[:, at:at + d.shape[1]]
            at += d.shape[1]
            if d.dtype != object and cen.dtype == object:
                d = d.astype(object)
            part = ((d[:, None, :] - cen[None, :, :]) ** 2).sum(axis=2)
            total = total + part[c]
        return total

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cluster, distance): the smaller number wins ties."""
        d = self.distances(centroids)
        if d.dtype == object:                                   # argmin of objects is not stable in ties
            cl = np.array([min(range(len(r)), key=lambda i: (r[i], i)) for r in d.tolist()], np.int64)
        else:
            cl = d.argmin(axis=1)
        return cl, d[np.arange(len(cl)), cl]

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """(k, dims) sums of the vectors of each cluster: uses of each code times its subvector."""
        out = []
        for d, c in zip(self.dicts, self.codes):
            uses = np.bincount(cluster * len(d) + c, minlength=k * len(d)).reshape(k, len(d))
            out.append(uses.astype(d.dtype) @ d)
        return np.concatenate(out, axis=1)

    # stored form: one array of codes, one of dictionary values, the sizes
    def pack(self) -> dict:
        wide = any(d.dtype == object for d in self.dicts)
        sizes = [len(d) for d in self.dicts]
        if wide:
            text = [str(v) for d in self.dicts for v in d.ravel().tolist()]
            return {"codes": self.codes.tobytes(), "sizes": sizes, "dict": None, "wide": text}
        flat = np.concatenate([d.ravel() for d in self.dicts]).astype(np.int32)
        return {"codes": self.codes.tobytes(), "sizes": sizes, "dict": flat.tobytes(), "wide": None}

    @classmethod
    def unpack(cls, row: dict, dims: int, block: int) -> "Chunk":
        codes = np.frombuffer(row["codes"], np.int32).reshape(len(row["sizes"]), -1)
        if row["wide"] is None:
            flat = np.frombuffer(row["dict"], np.int32).astype(np.int64)
        else:
            flat = np.empty(len(row["wide"]), object)
            flat[:] = [int(v) for v in row["wide"]]
        dicts, at = [], 0
        for b, n in enumerate(row["sizes"]):
            w = min(block, dims - b * block)
            dicts.append(flat[at:at + n * w].reshape(n, w))
            at += n * w
        return cls(dicts, codes)


_CHUNK = "ids array<long>, codes binary, sizes array<int>, dict binary, wide array<string>"


def _encode_batch(dims: int, block: int, scale: int, rows: int):
    import pyarrow as pa

    def one(ids, x):
        p = Chunk.of(integers(x, scale), block).pack()
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([p["codes"]], pa.binary()), pa.array([p["sizes"]], pa.list_(pa.int32())),
             pa.array([p["dict"]], pa.binary()), pa.array([p["wide"]], pa.list_(pa.string()))],
            names=["ids", "codes", "sizes", "dict", "wide"])

    def run(batches):
        ids, xs, n = [], [], 0
        for batch in batches:
            i, x = vectors_of(batch, dims)
            ids += i.to_pylist()
            xs.append(x)
            n += len(x)
            while n >= rows:
                whole = np.concatenate(xs)
                yield one(ids[:rows], whole[:rows])
                ids, xs, n = ids[rows:], [whole[rows:]], n - rows
        if n:
            yield one(ids, np.concatenate(xs))
    return run


def encode(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, block: int = 4,
           scale: int = 1024, rows: int = CHUNK) -> DataFrame:
    """The written table of chunks: ids, codes and dictionaries of up to ``rows`` vectors each."""
    src = vectors.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{vector_col}`").alias("_v"))
    return materialise(src.mapInArrow(_encode_batch(dims, block, scale, rows), _CHUNK))


# --- rounds -----------------------------------------------------------------

def first_centroids(vectors: DataFrame, k: int, seed: int, *, id_col: str, vector_col: str, dims: int, scale: int) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of ``seed:id``, in that order."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    fine = (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("long").cast("string"), F.lit(""))), 256)
    rows = vectors.where(fine).select(h.alias("h"), v.alias("v")).orderBy("h", "v").limit(k).collect()     # k rows
    return _array([[scaled(x, scale) for x in r["v"]] for r in rows], dims)


def _array(rows: list[list[int]], dims: int) -> np.ndarray:
    wide = any(abs(x) > SAFE for r in rows for x in r)
    out = np.empty((len(rows), dims), object if wide else np.int64)
    for i, r in enumerate(rows):
        out[i] = r
    return out


def limbs(v: int):
    """(limb, value) parts of an integer; the value of limb i counts 10**(LIMB * i)."""
    sign, v, i = (-1 if v < 0 else 1), abs(int(v)), 0
    while v:
        v, part = divmod(v, 10 ** LIMB)
        yield i, sign * part
        i += 1


def _parts_batch(centroids: np.ndarray, dims: int, block: int, inertia: bool):
    """Per task: (cluster, dim, limb, value) of the sums of its chunks; dim -1 counts vectors, -2 sums distances."""
    import pyarrow as pa
    k = len(centroids)

    def run(batches):
        total: dict = {}

        def add(key, v):
            total[key] = total.get(key, 0) + int(v)
        for batch in batches:
            for row in batch.to_pylist():
                ch = Chunk.unpack(row, dims, block)
                cl, dist = ch.nearest(centroids)
                for c, n in enumerate(np.bincount(cl, minlength=k).tolist()):
                    if n:
                        add((c, -1), n)
                if inertia:
                    for c in range(k):
                        add((c, -2), sum(dist[cl == c].tolist()))
                else:
                    s = ch.sums(cl, k)
                    for c in np.unique(cl).tolist():
                        for j in range(dims):
                            add((c, j), s[c, j])
        rows = [(c, j, i, v) for (c, j), x in total.items() for i, v in limbs(x)]
        cols = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
                                          pa.array(cols[3], pa.int64())], names=["c", "j", "limb", "v"])
    return run


def _totals(chunks: DataFrame, centroids: np.ndarray, dims: int, block: int, inertia: bool = False) -> dict:
    """{(cluster, dim): exact sum}; at most centroids x (dims + 1) sums of a few limbs reach the driver."""
    parts = chunks.mapInArrow(_parts_batch(centroids, dims, block, inertia), "c int, j int, limb int, v long")
    out: dict = {}
    for r in parts.groupBy("c", "j", "limb").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v")).collect():
        out[(r["c"], r["j"])] = out.get((r["c"], r["j"]), 0) + int(r["v"]) * 10 ** (LIMB * r["limb"])
    return out


def lloyd(chunks: DataFrame, centroids: np.ndarray, rounds: int, dims: int, block: int) -> np.ndarray:
    """``rounds`` times: assign, then floor(sum / count) per component; empty clusters stay."""
    for _ in range(rounds if len(centroids) else 0):
        t = _totals(chunks, centroids, dims, block)
        new = [[t.get((c, j), 0) // t[(c, -1)] for j in range(dims)] if (c, -1) in t else [int(x) for x in centroids[c]]
               for c in range(len(centroids))]
        new = _array(new, dims)
        if new.dtype == centroids.dtype and (new == centroids).all():
            break                                              # a fixed point: later rounds change nothing
        centroids = new
    return centroids


def _assign_batch(centroids: np.ndarray, dims: int, block: int, shown: list[tuple]):
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                cl, dist = Chunk.unpack(row, dims, block).nearest(centroids)
                d = [x if x < LONG else None for x in dist.tolist()]
                cols = [pa.array([shown[c][i] for c in cl.tolist()], t) for i, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.string()))]
                yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(cl, pa.int32()), pa.array(d, pa.int64()), *cols],
                                                 names=["_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])
    return run


def cluster(vectors: DataFrame, *, k: int = 8, rounds: int = 10, seed: int = 3, id_col: str = "vec_id", vector_col: str = "embedding",
            dims: int = 64, block: int = 4, scale: int = 1024) -> DataFrame:
    """Per vector: id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``."""
    cen = first_centroids(vectors, k, seed, id_col=id_col, vector_col=vector_col, dims=dims, scale=scale)
    chunks = encode(vectors, id_col=id_col, vector_col=vector_col, dims=dims, block=block, scale=scale)
    cen = lloyd(chunks, cen, rounds, dims, block)
    t = _totals(chunks, cen, dims, block, inertia=True) if len(cen) else {}
    whole = sum(v for (_, j), v in t.items() if j == -2)
    fit = lambda v: v if v < LONG else None
    shown = [(fit(t.get((c, -2), 0)), fit(whole), hashlib.sha256(",".join(str(int(x)) for x in cen[c]).encode()).hexdigest())
             for c in range(len(cen))]
    out = chunks.mapInArrow(_assign_batch(cen, dims, block, shown),
                            "_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.withColumnRenamed("_id", id_col)
