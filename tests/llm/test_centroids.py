import hashlib
import math

import numpy as np
import pytest

from tessera.llm import centroids

DIMS = 6
COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def brute(rows, k=3, rounds=4, dims=DIMS, seed=3):
    """Plain Lloyd in Python integers over whole vectors."""
    ok = [(i, [int(x) * 1024 if abs(x) >= 2 ** 53 else math.floor(1024 * x) for x in v]) for i, v in rows
          if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    cen = [v for _, v in sorted(ok, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cen))
    for _ in range(rounds):
        got = [near(v)[1] for _, v in ok]
        for c in range(len(cen)):
            mine = [v for (_, v), g in zip(ok, got) if g == c]
            if mine:
                cen[c] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [near(v) for _, v in ok]
    fit = lambda x: x if x < 2 ** 63 else None
    return [(i, c, fit(d), fit(sum(e for e, g in last if g == c)), fit(sum(e for e, _ in last)),
             hashlib.sha256(",".join(map(str, cen[c])).encode()).hexdigest()) for (i, _), (d, c) in zip(ok, last)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, 1) for i, v in rows], "vec_id long, embedding array<double>, cluster int, c int").repartition(3)


def key(r):
    return tuple((x is None, x) for x in r)


@pytest.mark.parametrize("kind", ["clusters", "ties", "large", "few", "none"])
def test_against_brute_force(spark, kind):
    rng = np.random.default_rng(11)
    if kind == "clusters":
        rows = [(i, (rng.normal(size=DIMS) * 0.1 + 3 * (i % 4)).tolist()) for i in range(120)]
    elif kind == "ties":                                       # few values, repeated rows and ids, a null id
        rows = [(i % 40 if i else None, [float(x) for x in rng.integers(0, 2, DIMS)]) for i in range(120)]
    elif kind == "large":
        rows = [(i, (rng.normal(size=DIMS) * 10.0 ** (i % 40)).tolist()) for i in range(60)] + [(99, [1.7e308] * DIMS)]
    elif kind == "few":
        rows = [(1, [0.5] * DIMS), (2, [-0.25] * DIMS)]
    else:
        rows = []
    bad = [(900, None), (901, [1.0] * (DIMS - 1)), (902, [1.0] * (DIMS - 1) + [None]), (903, [float("nan")] * DIMS),
           (904, [float("inf")] + [0.0] * (DIMS - 1)), (905, [])]
    got = centroids.cluster(frame(spark, rows + bad), k=3, rounds=4, dims=DIMS, block=4).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows + bad), key=key)


def test_partial_sums_over_codes():
    """Dictionaries are lossless, and sums by code equal sums by vector."""
    rng = np.random.default_rng(1)
    x = rng.integers(-3, 3, (500, 10))
    cen = rng.integers(-3, 3, (5, 10))
    for data in (x, x.astype(object) * 10 ** 30):
        ch = centroids.Chunk.unpack(centroids.Chunk.of(data, 4).pack(), 10, 4)
        back = np.concatenate([d[c] for d, c in zip(ch.dicts, ch.codes)], axis=1)
        assert (back == data).all() and max(map(len, ch.dicts)) < 500
        want = ((data[:, None, :] - cen[None]) ** 2).sum(axis=2)
        assert (ch.distances(cen) == want).all()
        cl, _ = ch.nearest(cen)
        assert (ch.sums(cl, 5) == np.array([data[cl == c].sum(axis=0) if (cl == c).any() else data[:0].sum(axis=0) for c in range(5)])).all()


def test_chunks_do_not_matter(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=DIMS).tolist()) for i in range(100)]
    df = frame(spark, rows)
    cen = centroids.first_centroids(df, 3, 3, id_col="vec_id", vector_col="embedding", dims=DIMS, scale=1024)
    one = [centroids.lloyd(centroids.encode(df, dims=DIMS, block=b, rows=n), cen, 5, DIMS, b) for b, n in ((4, 7), (2, 1000), (6, 33))]
    assert all((c == one[0]).all() for c in one)
