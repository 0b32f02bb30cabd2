"""Near-duplicate detection with SetSketch registers.

A document's set is its distinct ``k``-word shingles. Its sketch holds ``m``
registers ``K_i = floor(1 - log_b min_d x_i(d))`` (clipped to 16 bits), where
x_i(d) is an exponential variate of rate ``a`` derived from the shingle's
hash: exponentially spaced truncated minima. Registers of a union are the
elementwise maximum (``merge``); a register agrees between two sets with a
probability of at least their Jaccard similarity, so the sketch is
locality-sensitive.

1. Documents with equal sets form one class (128-bit set fingerprint); only
   classes go on. A class is named by a hash of its fingerprint, so two texts
   that share a doc_id are two classes; they are linked as one document.
2. Bands of ``r`` registers are hashed; classes sharing a band value are
   candidates. Each bucket links its members to its smallest member (a star,
   not all pairs), the similarity is estimated from both sketches and set
   sizes by maximum likelihood, and surviving pairs are verified on full sets.
3. Components of the verified links. A bucket whose members then lie in more
   than one component may still hide a link between two of its components:
   all cross pairs of such buckets are estimated blockwise from the registers
   inside tasks, and the promising ones verified, best first, until no
   unresolved pair is left. Components are computed again.

With m = 128, r = 4 a pair of similarity 0.85 shares no band with probability
6e-11 (0.80: 5e-8); the estimate's standard error there is 0.032 (0.035), and
pairs are dropped unverified only ``errors`` (4.5) of them below the threshold.

Defined results: null or empty texts have the empty set, link with nothing and
are kept; texts of fewer than k words have their whole word sequence as the
only element; rows sharing a doc_id are one document, linked with whatever any
of them is near to; rows with a null doc_id take no part in linking (component
null, kept). Ties cannot matter: the smallest doc_id names a component. "Full
sets" are sets of 64-bit shingle fingerprints.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .store import materialise
from .text import NONSPACE, Words, chunks, mix, ngram_hashes

M, R = 128, 4
A, B = 20.0, 1.001
Q = (1 << 16) - 2
#: members of a block when a bucket's cross pairs are estimated
BLOCK = 512

_rng = np.random.default_rng(77)
_MUL = _rng.integers(0, 1 << 62, M, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 62, M, dtype=np.uint64)


def shingle_sets(data, offs, k: int):
    """Distinct sorted k-word shingle hashes of each document of a chunk."""
    w = Words(data, offs, NONSPACE)
    h = w.hashes()
    for d in range(len(offs) - 1):
        a, b = int(w.first[d]), int(w.first[d + 1])
        if b == a:
            yield np.zeros(0, np.uint64)
        else:
            yield np.unique(ngram_hashes(h[a:b], min(k, b - a)))


def registers(s: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes."""
    least = np.full(M, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(s), 2048):
        x = s[lo:lo + 2048, None] * _MUL + _ADD
        np.minimum(least, x.min(axis=0), out=least)
    # the high bits of an odd multiple are uniform: u is the smallest of |s| uniform values
    u = (least.astype(np.float64) + 1.0) * 2.0 ** -64
    x = -np.log1p(-np.minimum(u, 1 - 1e-12)) / A
    return np.clip(np.floor(1 - np.log(x) / np.log(B)), 0, Q + 1).astype(np.uint16)


def merge(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(one, two)


def band_keys(regs: np.ndarray, r: int = R) -> np.ndarray:
    v = regs.reshape(-1, r).astype(np.uint64)
    h = np.arange(len(v), dtype=np.uint64) + np.uint64(1)
    for j in range(r):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + v[:, j])
    return h


def _pb(x):
    """P(K_1 > K_2) when the first set's surplus is the share x of the union's mass."""
    return -np.log1p(-x * (B - 1) / B) / np.log(B)


def log_likelihood(j, above, equal, below, n1, n2):
    """Joint log-likelihood of register comparisons given Jaccard j and set sizes."""
    u = n1 / (n1 + n2)
    v = 1 - u
    pa = np.clip(_pb(np.maximum(u - v * j, 0)), 1e-12, 1)
    pb = np.clip(_pb(np.maximum(v - u * j, 0)), 1e-12, 1)
    p0 = np.clip(1 - pa - pb, 1e-12, 1)
    return above * np.log(pa) + equal * np.log(p0) + below * np.log(pb)


_GRID = np.concatenate([np.arange(0, 0.5, 0.05), np.arange(0.5, 1.0001, 0.01)])


def estimate(r1: np.ndarray, r2: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard of register rows r1[i], r2[i] with set sizes n1[i], n2[i] (grid of 0.01 above 0.5)."""
    above = (r1 > r2).sum(-1)[..., None]
    below = (r1 < r2).sum(-1)[..., None]
    equal = M - above - below
    n1, n2 = np.asarray(n1, float)[..., None], np.asarray(n2, float)[..., None]
    best = np.minimum(n1, n2) / np.maximum(n1, n2)                  # no larger Jaccard is possible
    ll = log_likelihood(np.minimum(_GRID, best), above, equal, below, n1, n2)
    return np.minimum(_GRID[ll.argmax(-1)], best[..., 0])


def _sketch_batch(k: int):
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in chunks(batch.column("_text")):
                n, f1, f2, regs, keys = [], [], [], [], []
                for s in shingle_sets(data, offs, k):
                    n.append(len(s))
                    f1.append(int(s.sum(dtype=np.uint64)))
                    f2.append(int(mix(s).sum(dtype=np.uint64)))
                    r = registers(s) if len(s) else None
                    regs.append(None if r is None else r.tobytes())
                    keys.append(None if r is None else band_keys(r).view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    batch.column("_id").slice(lo, hi - lo), pa.array(n, pa.int64()),
                    pa.array(np.array(f1, np.uint64).view(np.int64)), pa.array(np.array(f2, np.uint64).view(np.int64)),
                    pa.array(regs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["_id", "n", "f1", "f2", "regs", "bands"])
    return run


def _sets_batch(k: int):
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in chunks(batch.column("_text")):
                sets = [s.view(np.int64) for s in shingle_sets(data, offs, k)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(lo, hi - lo),
                     pa.array([int(s.view(np.uint64).sum(dtype=np.uint64)) for s in sets], pa.uint64()).view(pa.int64()),
                     pa.array(sets, pa.list_(pa.int64()))], names=["rep", "f1", "items"])
    return run


def _estimate_batch(floor: float):
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            get = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, M)
            r1, r2 = get("r1"), get("r2")
            e = np.zeros(len(r1))
            may = np.flatnonzero((r1 == r2).sum(1) >= (floor - 0.03) * M)
            e[may] = estimate(r1[may], r2[may], batch.column("n1").to_numpy()[may], batch.column("n2").to_numpy()[may])
            ok = pa.array(e >= floor)
            yield pa.RecordBatch.from_arrays([batch.column("u").filter(ok), batch.column("v").filter(ok)], names=["u", "v"])
    return run


def sketches(docs: DataFrame, *, doc_id: str, text_col: str, k: int) -> DataFrame:
    """One row per document row: ``_id``, set size ``n``, set fingerprint ``f1, f2``, registers, band keys."""
    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    return src.mapInArrow(_sketch_batch(k), "_id long, n long, f1 long, f2 long, regs binary, bands array<long>")


def _full_sets(docs, nodes, doc_id, text_col, k) -> DataFrame:
    """Shingle sets of the classes in ``nodes`` (node, f1, rep), from the text of the class's smallest document ``rep``."""
    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    src = src.join(nodes.select(F.col("rep").alias("_id")), "_id", "left_semi")
    sets = src.mapInArrow(_sets_batch(k), "rep long, f1 long, items array<long>")
    return sets.join(nodes, ["rep", "f1"]).groupBy("node").agg(F.first("items").alias("items"))


def _verify(pairs: DataFrame, classes: DataFrame, docs, doc_id, text_col, k, num, den) -> DataFrame:
    """Pairs (u, v) whose full sets satisfy den * |u and v| >= num * |u or v|."""
    ends = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    nodes = materialise(classes.select("node", "f1", "rep").join(ends, "node"))
    sets = materialise(_full_sets(docs, nodes, doc_id, text_col, k))
    j = pairs.join(sets.select(F.col("node").alias("u"), F.col("items").alias("a")), "u") \
        .join(sets.select(F.col("node").alias("v"), F.col("items").alias("b")), "v")
    inter = F.size(F.array_intersect("a", "b")).cast("long")
    union = F.size("a") + F.size("b") - inter
    return j.where(den * inter >= num * union).select("u", "v")


def _cells(batches, names):
    """Cells (runs of equal band, i, j) of a sorted Arrow stream, as dicts of arrays; ``items`` are lists of sorted hashes."""
    held = None
    for batch in batches:
        new = {c: batch.column(c).to_numpy() for c in names}
        new["regs"] = np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint16).reshape(-1, M)
        if "items" in batch.schema.names:
            col = batch.column("items")
            vals, offs = col.values.to_numpy().view(np.uint64), col.offsets.to_numpy()
            new["items"] = np.empty(len(offs) - 1, object)
            new["items"][:] = [vals[x:y] for x, y in zip(offs[:-1], offs[1:])]
        held = new if held is None else {c: np.concatenate([held[c], new[c]]) for c in new}
        cut = np.flatnonzero((held["band"][1:] != held["band"][:-1]) | (held["i"][1:] != held["i"][:-1])
                             | (held["j"][1:] != held["j"][:-1])) + 1
        for lo, hi in zip(np.concatenate(([0], cut[:-1])), cut):               # the last cell may go on
            yield {c: x[lo:hi] for c, x in held.items()}
        if len(cut):
            held = {c: x[cut[-1]:] for c, x in held.items()}
    if held is not None and len(held["band"]):
        yield held


def _promising(cell, floor: float):
    """Pairs (a, b, estimate) of a cell between components, each only in the first band its sketches share."""
    same = cell["i"][0] == cell["j"][0]
    blk = cell["blk"]
    left = np.arange(len(blk)) if same else np.flatnonzero(blk == cell["i"][0])
    right = left if same else np.flatnonzero(blk == cell["j"][0])
    n, comp, regs, pos = cell["n"].astype(float), cell["component"], cell["regs"], cell["pos"][0]
    for at, a in enumerate(left):
        r = right[at + 1:] if same else right
        r = r[(comp[r] != comp[a]) & (np.minimum(n[r], n[a]) >= floor * np.maximum(n[r], n[a]))]
        if not len(r):
            continue
        # registers agree with a probability of at least the similarity
        agree = regs[r] == regs[a]
        may = np.flatnonzero(agree.sum(1) >= (floor - 0.03) * M)
        may = may[agree[may].reshape(len(may), M // R, R).all(2).argmax(1) == pos]
        if not len(may):
            continue
        r = r[may]
        e = estimate(np.broadcast_to(regs[a], (len(r), M)), regs[r], np.full(len(r), n[a]), n[r])
        for b, x in zip(r[e >= floor].tolist(), e[e >= floor].tolist()):
            yield int(a), b, x


_CELL = ("band", "i", "j", "blk", "pos", "node", "n", "component")


def _open_members(floor: float):
    """The members of each cell that have a promising partner: (band, i, j, blk, pos, node)."""
    import pyarrow as pa
    names = ["band", "i", "j", "blk", "pos", "node"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]

    def run(batches):
        for cell in _cells(batches, _CELL):
            use = sorted({x for a, b, _ in _promising(cell, floor) for x in (a, b)})
            if use:
                yield pa.RecordBatch.from_arrays([pa.array(cell[c][use]).cast(k) for c, k in zip(names, kinds)], names=names)
    return run


def _cell_links(floor: float, num: int, den: int):
    """Verified links that join components of a cell, best estimates first; pairs already joined need no look."""
    import pyarrow as pa

    def run(batches):
        for cell in _cells(batches, _CELL):
            up: dict = {}

            def find(x):
                while up.setdefault(x, x) != x:
                    up[x] = up[up[x]]
                    x = up[x]
                return x

            comp, items, links = cell["component"].tolist(), cell["items"], []
            for a, b, _ in sorted(_promising(cell, floor), key=lambda t: -t[2]):
                x, y = find(comp[a]), find(comp[b])
                if x == y:
                    continue
                s, t = sorted((items[a], items[b]), key=len)
                at = np.minimum(np.searchsorted(t, s), len(t) - 1)
                both = int((t[at] == s).sum())
                if den * both >= num * (len(s) + len(t) - both):
                    up[x] = y
                    links.append((int(cell["node"][a]), int(cell["node"][b])))
            if links:
                u, v = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
    return run


def _cross_links(members, classes, label, floor, docs, doc_id, text_col, k, num, den) -> DataFrame:
    """Links between components that share a bucket. members: (band, pos, node) of shared buckets.

    First the registers alone tell which members have a promising partner at
    all; only these get their full sets. Neither step emits pairs: the first
    returns members, the second at most one link per component joined.
    """
    lab = members.join(label, "node", "left").select("band", "pos", "node", F.coalesce("component", "node").alias("component"))
    mixed = materialise(lab.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                                F.count(F.lit(1)).alias("size")).where(F.col("lo") != F.col("hi")))
    own = materialise(classes.select("node", "n", "regs").join(label, "node", "left")
                      .select("node", "n", "regs", F.coalesce("component", "node").alias("component")))
    lab = members.join(mixed.select("band", "size"), "band").join(own, "node")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    lab = lab.withColumn("blocks", blocks).withColumn("blk", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    t = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("t")
    cells = lab.select("band", "pos", "node", "n", "regs", "component", "blk", t)
    cells = cells.withColumn("i", F.least("blk", "t")).withColumn("j", F.greatest("blk", "t")).drop("t")
    # a pair of blocks is one cell: a hot bucket becomes many cells of bounded size
    cells = cells.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    live = materialise(cells.mapInArrow(_open_members(floor), "band long, i int, j int, blk int, pos int, node long"))
    nodes = materialise(live.select("node").distinct().join(classes.select("node", "f1", "rep"), "node"))
    sets = materialise(_full_sets(docs, nodes, doc_id, text_col, k))
    full = live.join(own, "node").join(sets, "node").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    return full.mapInArrow(_cell_links(floor, num, den), "u long, v long")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text", k: int = 5,
                    num: int = 80, den: int = 100, errors: float = 4.5) -> DataFrame:
    """Link documents with den * |intersection| >= num * |union| of their shingle sets.

    Returns one row per document row: ``doc_id``, ``n_shingles``,
    ``component_id`` (smallest doc_id reachable), ``kept``.
    """
    want = num / den
    floor = max(0.0, want - errors * (want * (1 - want) / M) ** 0.5)
    sig = materialise(sketches(docs, doc_id=doc_id, text_col=text_col, k=k))
    live = sig.where((F.col("n") > 0) & F.col("_id").isNotNull())
    name = F.xxhash64("f1", "f2", "n")
    classes = materialise(live.groupBy("f1", "f2", "n").agg(F.min("_id").alias("rep"), F.first("regs").alias("regs"),
                                                            F.first("bands").alias("bands")).withColumn("node", name))
    # rows sharing a doc_id are one document: their classes are linked
    shared = materialise(live.groupBy("_id").agg(F.min(name).alias("u"), F.max(name).alias("last")).where("u <> last").select("_id", "u"))
    same = materialise(live.join(shared, "_id").select("u", name.alias("v")).where("u <> v").distinct())
    bands = classes.select("node", F.posexplode("bands").alias("pos", "band"))
    buckets = materialise(bands.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
                          .where(F.col("lo") != F.col("hi")))
    members = materialise(bands.join(buckets.select("band", "lo"), "band").select("band", "pos", "node", "lo"))
    star = members.where("node != lo").select(F.col("lo").alias("u"), F.col("node").alias("v")).distinct()
    c = classes.select("node", "n", "regs")
    cand = star.join(c.select(F.col("node").alias("u"), F.col("n").alias("n1"), F.col("regs").alias("r1")), "u") \
        .join(c.select(F.col("node").alias("v"), F.col("n").alias("n2"), F.col("regs").alias("r2")), "v")
    pairs = materialise(cand.mapInArrow(_estimate_batch(floor), "u long, v long"))
    edges = materialise(_verify(pairs, classes, docs, doc_id, text_col, k, num, den).union(same))
    label = materialise(connected_components(edges))
    found = materialise(_cross_links(members.select("band", "pos", "node"), classes, label, floor, docs, doc_id, text_col, k, num, den))
    if not found.isEmpty():
        label = materialise(connected_components(edges.union(found)))
    # a component's smallest doc_id names it
    smallest = classes.select("node", "rep").join(label, "node").groupBy("component").agg(F.min("rep").alias("first"))
    names = materialise(label.join(smallest, "component").select("node", "first"))
    own = sig.join(classes.select("f1", "f2", "n", "node", "rep"), ["f1", "f2", "n"], "left").join(names, "node", "left")
    comp = F.when(F.col("_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("first", "rep", "_id"))
    return own.select(F.col("_id").alias(doc_id), F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.coalesce(F.col("_id") == comp, F.lit(True)).alias("kept"))
