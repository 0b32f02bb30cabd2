"""Exact top-k inner-product search with M-trees.

Maximum inner product becomes nearest neighbour by one more component:
x' = (x, sqrt(max - |x|^2)) and q' = (q, 0) give |q' - x'|^2 = |q|^2 + max - 2 q.x.

Rows are dealt by hash into shards of about ``SHARD`` rows; each shard's
vectors are bulk-loaded into an M-tree whose nodes are rows of a written table
("pages"): a leaf page holds up to ``PAGE`` entries with their distance to the
page's routing object; an inner page holds routing objects with covering radii
and distances to their parent. A search runs best first over the nodes'
lower bounds max(0, d(q, routing) - radius); before a distance is computed it
tries |d(q, parent) - d(entry, parent)| - radius, from the stored distances,
against the query's k-th best so far, and skips what cannot win. Queries visit
every shard (in blocks of ``QUERY_BLOCK``), carrying the bound found in their
block's first look at the shard; a merge keeps the best k per query.

Distances are doubles and only prune, with a tolerance above their rounding
error; scores are exact integers, so results are exact, ties to smaller ids.

Defined results: vectors that are null or hold null or non-finite components,
and rows with a null id, take no part; a query meets only vectors of its own
dimension; repeated rows are candidates each, and rows with the query's own id
are not; empty tables give no rows. Scaled components must stay below 2**24 in
magnitude (products are summed in 64-bit integers); larger ones raise an error.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialise

SHARD, PAGE, FAN, QUERY_BLOCK = 8192, 64, 16, 512


def quantise(vectors: DataFrame, *, vec_id: str, column: str, scale: float = 1024.0) -> DataFrame:
    """(vec_id, v, dim): floor(scale * x) of every valid vector, components as long."""
    x = F.col(f"`{column}`")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    v = F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")))
    v = F.when(F.exists(x, lambda e: F.abs(e.cast("double")) >= float(1 << 24) / scale),
               F.raise_error(F.lit("component too large for exact scores"))).otherwise(v)
    ok = F.col(f"`{vec_id}`").isNotNull() & x.isNotNull() & ~bad
    return vectors.where(ok).select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v"), F.size(x).alias("dim"))


def _dist(a, b):
    return np.sqrt(np.maximum(((a - b) ** 2).sum(-1), 0.0))


def _split(x: np.ndarray, rows: np.ndarray, rng) -> list[np.ndarray]:
    """Deal rows to up to FAN routing objects spread over the set (farthest-first from a sample), nearest wins."""
    sample = rows if len(rows) <= 256 else rng.choice(rows, 256, replace=False)
    picks = [sample[0]]
    near = _dist(x[sample], x[picks[0]])
    while len(picks) < FAN and near.max() > 0:
        picks.append(sample[int(near.argmax())])
        near = np.minimum(near, _dist(x[sample], x[picks[-1]]))
    if len(picks) == 1:                                  # equal vectors: any cut will do
        return np.array_split(rows, -(-len(rows) // PAGE))
    d = np.stack([_dist(x[rows], x[p]) for p in picks], 1)
    own = d.argmin(1)
    return [rows[own == i] for i in range(len(picks)) if (own == i).any()]


def build(x: np.ndarray, seed: int = 3) -> list[tuple]:
    """Pages (id, parent, leaf, routing row, radius, distance to parent, entry rows, entry distances), root first."""
    rng = np.random.default_rng(seed)
    pages = []
    todo = [(np.arange(len(x)), -1, -1, 0.0)]
    while todo:
        rows, parent, up, dp = todo.pop()
        centre = x[rows].mean(0)
        route = int(rows[_dist(x[rows], centre).argmin()])
        if up >= 0:
            dp = float(_dist(x[route], x[up]))
        d = _dist(x[rows], x[route])
        me = len(pages)
        leaf = len(rows) <= PAGE
        pages.append((me, parent, leaf, route, float(d.max()), dp, rows if leaf else None, d if leaf else None))
        if not leaf:
            todo += [(part, me, route, 0.0) for part in _split(x, rows, rng)]
    return pages


class Tree:
    def __init__(self, ids, v, extra, pages):
        self.ids, self.v = ids, v
        self.x = np.concatenate([v.astype(float), extra[:, None]], 1)
        self.pages = pages
        self.kids: dict[int, list[int]] = {}
        for p in pages:
            self.kids.setdefault(p[1], []).append(p[0])
        self.eps = 1e-6 * (1.0 + float(np.abs(self.x).max(initial=0.0)) * np.sqrt(self.x.shape[1]))

    def search(self, q: np.ndarray, own: int, k: int, top: float):
        """The k largest (score, id) of one query; ``top`` is |q|^2 + the maximum squared norm. Also the distances computed."""
        qx = np.append(q.astype(float), 0.0)
        best: list[tuple[int, int]] = []                  # heap of (score, -id): worst first
        reach = np.inf
        computed = 0
        root = self.pages[0]
        d = float(_dist(qx, self.x[root[3]]))
        heap = [(max(0.0, d - root[4]), 0, d)]
        while heap:
            low, page, d = heapq.heappop(heap)
            if low > reach + self.eps:
                break
            p = self.pages[page]
            if p[2]:
                rows, dist = p[6], p[7]
                may = np.abs(d - dist) <= reach + self.eps
                rows = rows[may]
                score = self.v[rows] @ q
                computed += len(rows)
                if len(best) == k:
                    keep = score >= best[0][0]
                    rows, score = rows[keep], score[keep]
                for s, i in zip(score.tolist(), self.ids[rows].tolist()):
                    if i == own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heapq.heapreplace(best, (s, -i))
                if len(best) == k:
                    reach = np.sqrt(max(0.0, top - 2.0 * best[0][0]))
                continue
            kids = [c for c in self.kids.get(page, ())
                    if abs(d - self.pages[c][5]) - self.pages[c][4] <= reach + self.eps]
            if kids:
                dk = _dist(qx, self.x[[self.pages[c][3] for c in kids]])
                computed += len(kids)
                for c, dc in zip(kids, dk.tolist()):
                    low = max(0.0, dc - self.pages[c][4])
                    if low <= reach + self.eps:
                        heapq.heappush(heap, (low, c, dc))
        return sorted(((s, -i) for s, i in best), key=lambda t: (-t[0], t[1])), computed


_PAGES = ("dim int, shard int, page int, parent int, leaf boolean, route int, radius double, up double, "
          "ids array<long>, vectors array<long>, rows array<int>, dists array<double>, biggest long")


def _build_shard(key, pdf):
    import pandas as pd
    pdf = pdf.sort_values("vec_id", kind="stable").reset_index(drop=True)
    dim, shard = int(key[0]), int(key[1])
    v = np.array(pdf["v"].tolist(), np.int64).reshape(len(pdf), dim)
    norm = (v * v).sum(1)
    biggest = int(pdf["biggest"].iloc[0])
    x = np.concatenate([v.astype(float), np.sqrt(np.maximum(biggest - norm, 0).astype(float))[:, None]], 1)
    out = []
    for me, parent, leaf, route, radius, up, rows, d in build(x):
        hold = rows if leaf else np.zeros(0, np.int64)
        out.append((dim, shard, me, parent, leaf, route, radius, up, pdf["vec_id"].to_numpy()[hold].tolist(),
                    v[hold].ravel().tolist(), hold.tolist(), d.tolist() if leaf else [], biggest))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _PAGES.split(", ")])


def index(vectors: DataFrame, shard_rows: int = SHARD) -> DataFrame:
    """Pages of the shards' M-trees. ``vectors``: see ``quantise``."""
    per = vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n"),
                                     F.max(F.aggregate("v", F.lit(0).cast("long"), lambda s, e: s + e * e)).alias("biggest"))
    shards = F.ceil(F.col("n") / shard_rows).cast("int")
    rows = vectors.join(per, "dim").withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), shards).cast("int"))
    return rows.select("dim", "shard", "vec_id", "v", "biggest").groupBy("dim", "shard").applyInPandas(_build_shard, _PAGES)


def _load(pages) -> Tree:
    pages = pages.sort_values("page").reset_index(drop=True)
    dim = int(pages["dim"].iloc[0])
    n = sum(len(r) for r in pages["rows"])
    ids, v = np.zeros(n, np.int64), np.zeros((n, dim), np.int64)
    rows = []
    for p in pages.itertuples():
        r = np.asarray(p.rows, np.int64)
        if p.leaf:
            ids[r] = p.ids
            v[r] = np.asarray(p.vectors, np.int64).reshape(len(r), dim)
        rows.append((p.page, p.parent, p.leaf, p.route, p.radius, p.up, r, np.asarray(p.dists, float)))
    extra = np.sqrt(np.maximum(int(pages["biggest"].iloc[0]) - (v * v).sum(1), 0).astype(float))
    return Tree(ids, v, extra, rows)


def _search_cell(k: int):
    import pandas as pd

    def run(key, pages, queries):
        out = []
        if len(pages) and len(queries):
            tree, biggest = _load(pages), int(pages["biggest"].iloc[0])
            for q in queries.itertuples():
                v = np.asarray(q.v, np.int64)
                best, n = tree.search(v, q.query_id, k, float((v * v).sum() + biggest))
                out += [(q.query_id, i, s, n) for s, i in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "computed"]).astype("int64")
    return run


def top_k(pages: DataFrame, queries: DataFrame, k: int = 10, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query. ``queries``: (query_id, v, dim)."""
    shards = pages.select("dim", "shard").distinct()
    n = queries.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    blocks = n.select("dim", F.greatest(F.lit(1), F.ceil(F.col("n") / query_block)).cast("int").alias("blocks"))
    q = queries.join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64("query_id", "v"), F.col("blocks")).cast("int"))
    # each query goes to every shard, each shard's pages to every block: the blocks of a stated query set
    q = q.drop("blocks").join(shards, "dim").select(
        F.col("dim").alias("q_dim"), F.col("shard").alias("q_shard"), F.col("block").alias("q_block"), "query_id", "v")
    p = pages.join(blocks, "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    hits = p.groupBy("dim", "shard", "block").cogroup(q.groupBy("q_dim", "q_shard", "q_block")).applyInPandas(
        _search_cell(k), "query_id long, vec_id long, score long, computed long")
    best = hits.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(
        F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("pos", "b")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))


def search(vectors: DataFrame, *, vec_id: str = "vec_id", column: str = "embedding", every: int = 100, k: int = 10,
           shard_rows: int = SHARD, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Each row whose id is divisible by ``every`` against all other rows."""
    v = materialise(quantise(vectors, vec_id=vec_id, column=column))
    pages = materialise(index(v, shard_rows))
    queries = materialise(v.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v", "dim"))
    return top_k(pages, queries, k, query_block)
