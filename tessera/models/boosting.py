"""Gradient boosting on histograms with Newton steps, grown leaf by leaf.

Features are cut into at most ``max_bins`` bins; blocks of rows (see
``blocks``) hold a byte per feature and the margin reached so far. A job sends
the trees grown since the margins were written and the open nodes to the
tasks; these add up gradient, Hessian and row count per (node, feature, bin),
and Spark's sum of the arrays is all that reaches the driver: nodes x features
x bins x 3 numbers, whatever the number of rows.

Trees grow best first: of all leaves the one with the largest gain is split
next, until ``num_leaves``, ``max_depth`` or no gain ends the tree. A job looks
at the children of every leaf that may still be split, so a tree takes at most
as many jobs as it has levels; of two children the one with fewer rows is
counted, its sibling follows by subtraction from the parent. With few features
(``PAIR_CELLS``) a job counts pairs of features for the nodes at hand; the
histograms of their children follow from that table for any split, which
saves every other job near the root.

Every ``CUT`` trees the margins are written anew (the lineage stays short, lost
executors repeat their tasks only). Rows of one fold can be left out; their
loss comes with the first job of each tree and stops the growth early if asked.

Losses: ``logistic`` (label above 0 is class 1), ``squared``, ``huber`` (below). L1 and L2 penalties (``reg_alpha``,
``reg_lambda``) act on leaf values as in G -> sign(G) max(|G| - alpha, 0),
value -G / (H + lambda).

``huber``: per tree the quantile ``huber_alpha`` of the absolute residuals is
the bend; the tree is grown on the residuals clipped there, and each leaf's
value is the median of its residuals plus the mean of what deviates from it,
clipped at the bend. Quantiles and medians are exact order statistics (the
lower one), found digit by digit on the residuals' sorted bit patterns.

Ties between splits go to the smaller (feature, bin), between leaves to the
older one. Rows with a null or non-finite feature or label take no part.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import FitEstimator, StateModel
from .blocks import blocks_of, features_column, pack, release, sum_arrays

#: trees between two writings of the margins
CUT = 10
#: cells of the pair table of all nodes of a job (3 numbers each)
PAIR_CELLS = 1 << 17
#: bits of a residual's pattern that one job settles
DIGIT = 11


@dataclass
class Settings:
    n_estimators: int = 100
    learning_rate: float = 0.1
    max_depth: int | None = None
    num_leaves: int = 31
    reg_alpha: float = 0.0
    reg_lambda: float = 0.0
    min_samples_leaf: int = 20
    min_child_weight: float = 1e-3
    gamma: float = 0.0
    subsample: float = 1.0
    colsample: float = 1.0
    max_bins: int = 32
    loss: str = "logistic"
    huber_alpha: float = 0.9
    early_stopping: int | None = None
    seed: int = 42


@dataclass
class Node:
    depth: int
    g: float
    h: float
    n: float
    hist: np.ndarray | None = None              # (feature, bin, 3), once counted
    pairs: np.ndarray | None = None             # (feature, bin, feature, bin, 3), if counted
    gain: float = -math.inf
    feature: int = -1
    cut: int = -1
    children: tuple = ()
    parent: int = -1
    split: bool = False                         # split in the final tree
    value: float = 0.0


@dataclass
class Tree:
    """Arrays of a grown tree: bin <= cut goes left; feature -1 marks a leaf."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int = field(default=0)

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of each row of bins (or of raw features, if ``cut`` holds thresholds)."""
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            f = self.feature[at]
            down = np.where(x[rows, np.maximum(f, 0)] <= self.cut[at], self.left[at], self.right[at])
            at = np.where(f >= 0, down, at)
        return at


# --- bins -------------------------------------------------------------------

def bin_edges(df: DataFrame, features, width: int, max_bins: int) -> list[np.ndarray]:
    """Upper edges of the bins: quantiles of each feature over all rows (``percentile_approx``), distinct."""
    x = features_column(df, features)
    probs = [i / max_bins for i in range(1, max_bins)]
    fine = lambda i: F.when(~F.isnan(F.get(F.col("_x"), F.lit(i))) & (F.abs(F.get(F.col("_x"), F.lit(i))) < float("inf")), F.get(F.col("_x"), F.lit(i)))
    row = df.select(x.alias("_x")).agg(*[F.percentile_approx(fine(i), probs, 10_000).alias(f"q{i}") for i in range(width)]).first()
    return [np.unique(np.array(row[f"q{i}"] or [], np.float64)) for i in range(width)]


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin numbers: the number of edges below the value."""
    out = np.empty(x.shape, np.uint8)
    for i, e in enumerate(edges):
        out[:, i] = np.searchsorted(e, x[:, i], "left")
    return out


_STATE = "n int, x binary, y binary, w binary, fold binary"


def _binned(blocks: DataFrame, edges, base: float) -> DataFrame:
    """Blocks of bins; the weight array becomes the margin."""
    import pyarrow as pa

    def run(batches):
        for b in blocks_of(batches):
            yield _batch(pa, to_bins(b.x, edges), b.y, np.full(len(b.y), base), b.fold)
    return cut_lineage(blocks.mapInArrow(run, _STATE))


def _batch(pa, x, y, margin, fold):
    return pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32())] + [pa.array([np.ascontiguousarray(a).tobytes()], pa.binary())
                                                                          for a in (x, y, margin, fold)], names=["n", "x", "y", "w", "fold"])


def _advance(state: DataFrame, trees: list[Tree]) -> DataFrame:
    """The state with the trees' values added to its margins."""
    import pyarrow as pa

    def run(batches):
        for b in blocks_of(batches, np.uint8):
            yield _batch(pa, b.x, b.y, _margin(b, trees), b.fold)
    return cut_lineage(state.mapInArrow(run, _STATE))


def _margin(block, trees) -> np.ndarray:
    m = block.w
    for t in trees:
        m = m + t.value[t.leaf(block.x)]
    return m


# --- losses -----------------------------------------------------------------

def gradients(loss: str, y: np.ndarray, m: np.ndarray, bend: float = math.inf):
    if loss == "logistic":
        p = 0.5 * (1 + np.tanh(0.5 * m))
        return p - (y > 0), np.maximum(p * (1 - p), 1e-16)
    return np.clip(m - y, -bend, bend), np.ones(len(y))


def loss_sum(loss: str, y, m, bend: float = math.inf) -> float:
    if loss == "logistic":
        s = np.where(y > 0, m, -m)
        return float((np.maximum(-s, 0) + np.log1p(np.exp(-np.abs(s)))).sum())
    r = np.abs(y - m)
    return float(np.where(r <= bend, 0.5 * r * r, bend * (r - 0.5 * bend)).sum()) if math.isfinite(bend) else float(0.5 * (r * r).sum())


def _sampled(block, share: float, seed: int, tree: int) -> np.ndarray:
    """Row weights 0 or 1 of a tree, from a hash of the row's values and its place in the block."""
    if share >= 1:
        return np.ones(len(block.y))
    h = np.full(len(block.y), (seed * 1_000_003 + tree) % (1 << 61), np.uint64)
    for v in (*[block.x[:, i].astype(np.uint64) for i in range(block.x.shape[1])], block.y.view(np.uint64), np.arange(len(block.y)).astype(np.uint64)):
        h = (h ^ v) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return ((h >> np.uint64(11)).astype(np.float64) * 2.0 ** -53 < share).astype(np.float64)


# --- histograms -------------------------------------------------------------

def _slots(block, partial: Tree, slot_of: np.ndarray) -> np.ndarray:
    """Slot of each row: that of the open node it lies in, or -1."""
    return slot_of[partial.leaf(block.x)]


def _count(block, spec: dict) -> np.ndarray:
    """Sums of one job over a block: [left-out loss, rows] and the histograms of the open nodes."""
    s: Settings = spec["settings"]
    m = _margin(block, spec["trees"])
    out = block.fold == spec["leave_out"]
    head = np.array([loss_sum(s.loss, block.y[out], m[out], spec["bend"]), out.sum()]) if spec["first"] else np.zeros(2)
    slot = _slots(block, spec["partial"], spec["slot_of"])
    use = np.flatnonzero((slot >= 0) & ~out & (_sampled(block, s.subsample, s.seed, spec["tree"]) > 0))
    x, slot = block.x[use].astype(np.int64), slot[use].astype(np.int64)
    g, h = gradients(s.loss, block.y[use], m[use], spec["bend"])
    d, b, k = x.shape[1], spec["bins"], spec["slots"]
    parts = []
    if spec["pairs"]:
        for i in range(d):
            for j in range(i, d):
                at = ((slot * b + x[:, i]) * b + x[:, j])
                parts += [np.bincount(at, v, k * b * b) for v in (g, h, None)]
    else:
        for i in range(d):
            at = slot * b + x[:, i]
            parts += [np.bincount(at, v, k * b) for v in (g, h, None)]
    return np.concatenate([head, *parts])


def _unfold(total: np.ndarray, spec: dict, d: int):
    """[(hist, pairs)] of the slots from the summed array."""
    b, k = spec["bins"], spec["slots"]
    if not spec["pairs"]:
        a = total.reshape(d, 3, k, b)
        return [(np.ascontiguousarray(a[:, :, s, :].transpose(0, 2, 1)), None) for s in range(k)]
    a = total.reshape(-1, 3, k, b, b)
    out = []
    for s in range(k):
        t = np.zeros((d, b, d, b, 3))
        for p, (i, j) in enumerate((i, j) for i in range(d) for j in range(i, d)):
            c = a[p, :, s].transpose(1, 2, 0)
            t[i, :, j], t[j, :, i] = c, c.transpose(1, 0, 2)
        out.append((np.ascontiguousarray(np.stack([np.einsum("bbk->bk", t[i, :, i]) for i in range(d)])), t))
    return out


def _best_split(node: Node, s: Settings, features: np.ndarray) -> None:
    """The largest gain of a node whose histogram is known."""
    soft = lambda g: np.sign(g) * np.maximum(np.abs(g) - s.reg_alpha, 0.0)
    quality = lambda g, h: soft(g) ** 2 / np.maximum(h + s.reg_lambda, 1e-300)
    left = np.cumsum(node.hist, axis=1)[:, :-1]
    gl, hl, nl = left[..., 0], left[..., 1], np.rint(left[..., 2])
    gr, hr, nr = node.g - gl, node.h - hl, node.n - nl
    ok = (nl >= s.min_samples_leaf) & (nr >= s.min_samples_leaf) & (hl >= s.min_child_weight) & (hr >= s.min_child_weight)
    ok &= (nl > 0) & (nr > 0) & features[:, None]
    gain = np.where(ok, 0.5 * (quality(gl, hl) + quality(gr, hr) - quality(node.g, node.h)), -np.inf)
    at = int(gain.argmax())
    node.gain = float(gain.ravel()[at]) - s.gamma
    node.feature, node.cut = divmod(at, gain.shape[1])


def _children(nodes: list[Node], i: int) -> None:
    """Open the two children of a node that has a split; their sums follow from its histogram."""
    p = nodes[i]
    left = p.hist[p.feature, :p.cut + 1].sum(axis=0)
    a = Node(p.depth + 1, left[0], left[1], float(np.rint(left[2])), parent=i)
    b = Node(p.depth + 1, p.g - left[0], p.h - left[1], p.n - a.n, parent=i)
    if p.pairs is not None:
        t = p.pairs[p.feature]                                  # (bin of the split feature, feature, bin, 3)
        a.hist = t[:p.cut + 1].sum(axis=0)
        b.hist = p.hist - a.hist
    p.children = (len(nodes), len(nodes) + 1)
    nodes += [a, b]


def _as_tree(nodes: list[Node], follow) -> tuple[Tree, np.ndarray]:
    """(tree of the nodes for which ``follow`` holds, number of each of its places in ``nodes``)."""
    order, place = [0], {0: 0}
    for i in order:
        if follow(nodes[i]):
            for c in nodes[i].children:
                place[c] = len(order)
                order.append(c)
    inner = [follow(nodes[i]) for i in order]
    pick = lambda f: np.array([f(nodes[i]) if on else -1 for i, on in zip(order, inner)], np.int64)
    t = Tree(pick(lambda n: n.feature), pick(lambda n: n.cut), pick(lambda n: place[n.children[0]]), pick(lambda n: place[n.children[1]]),
             np.array([nodes[i].value for i in order]), max(nodes[i].depth for i in order))
    return t, np.array(order)


class _Grower:
    """Grows one tree; ``job`` counts histograms."""

    def __init__(self, state: DataFrame, s: Settings, bins: int, width: int):
        self.state, self.s, self.bins, self.width, self.jobs = state, s, bins, width, 0

    def job(self, trees, nodes, open_, tree_no, first, bend, leave_out):
        """Count the open nodes' histograms; returns the left-out [loss, rows]."""
        pairs = self.width * (self.width + 1) // 2 * self.bins ** 2 * len(open_) <= PAIR_CELLS
        want = list(open_)
        if not pairs:                                           # the smaller of two siblings; the other follows
            want = [i for i in open_ if nodes[i].parent < 0 or self._counted(nodes, i, open_)]
        partial, order = _as_tree(nodes, lambda n: bool(n.children))
        slot = np.full(len(nodes), -1)
        slot[want] = np.arange(len(want))
        spec = {"settings": self.s, "trees": trees, "partial": partial, "slot_of": slot[order], "slots": len(want), "bins": self.bins,
                "pairs": pairs, "tree": tree_no, "first": first, "bend": bend, "leave_out": -2 if leave_out is None else leave_out}
        tables = self.width * (self.width + 1) // 2 * self.bins ** 2 if pairs else self.width * self.bins
        total = sum_arrays(self.state, lambda b: _count(b, spec), np.uint8, 2 + 3 * len(want) * tables)
        self.jobs += 1
        if not len(total):
            raise ValueError("no complete rows to fit on")
        for i, (hist, table) in zip(want, _unfold(total[2:], spec, self.width)):
            nodes[i].hist, nodes[i].pairs = hist, table
        for i in open_:
            if nodes[i].hist is None:
                p = nodes[nodes[i].parent]
                other = p.children[0] if p.children[1] == i else p.children[1]
                nodes[i].hist = p.hist - nodes[other].hist
        return total[:2]

    @staticmethod
    def _counted(nodes, i, open_):
        a, b = nodes[nodes[i].parent].children
        other = b if a == i else a
        return other not in open_ or (nodes[i].n, i) < (nodes[other].n, other)

    def grow(self, trees, tree_no, bend=math.inf, leave_out=None, keep_going=lambda head: True):
        """The next tree, or None if ``keep_going`` (told the left-out loss) says so."""
        s = self.s
        rng = np.random.default_rng([s.seed, tree_no])
        features = np.zeros(self.width, bool)
        features[rng.permutation(self.width)[:max(1, round(s.colsample * self.width))]] = True
        nodes = [Node(0, 0.0, 0.0, 0.0)]
        head = self.job(trees, nodes, [0], tree_no, True, bend, leave_out)
        if not keep_going(head):
            return None
        nodes[0].g, nodes[0].h, nodes[0].n = nodes[0].hist[0].sum(axis=0)
        nodes[0].n = float(np.rint(nodes[0].n))
        _best_split(nodes[0], s, features)
        deep = s.max_depth if s.max_depth is not None and s.max_depth > 0 else 1 << 30
        while True:
            # best first over what is known; stops at a leaf whose gain is not known
            leaves, blocked, queue = 1, False, [(-nodes[0].gain, 0)]
            for n in nodes:
                n.split = False
            while queue and leaves < s.num_leaves:
                gain, i = heapq.heappop(queue)
                if -gain <= 0 or not math.isfinite(gain):
                    break
                n = nodes[i]
                if not n.children:
                    _children(nodes, i)
                n.split = True
                leaves += 1
                for c in n.children:
                    if nodes[c].depth >= deep:
                        continue
                    if nodes[c].hist is None:
                        blocked = True
                    else:
                        if nodes[c].gain == -math.inf and nodes[c].feature < 0:
                            _best_split(nodes[c], s, features)
                        heapq.heappush(queue, (-nodes[c].gain, c))
                if blocked:
                    break
            if not blocked:
                break
            # look at the children of every node that may still be split: those whose weakest gain
            # on the way down from a leaf is among the best
            weakest, room = [math.inf] * len(nodes), s.num_leaves - leaves
            for i, n in enumerate(nodes):
                if not n.split:
                    weakest[i] = min(n.gain, weakest[n.parent] if n.parent >= 0 else math.inf)
            may = [i for i, n in enumerate(nodes) if not n.split and n.hist is not None and weakest[i] > 0]
            for i in heapq.nsmallest(room, may, key=lambda i: (-weakest[i], i)):
                if not nodes[i].children:
                    _children(nodes, i)
            open_ = [i for i, n in enumerate(nodes) if n.hist is None and n.depth < deep]
            self.job(trees, nodes, open_, tree_no, False, bend, leave_out)
            for i in open_:
                _best_split(nodes[i], s, features)
        soft = lambda g: math.copysign(max(abs(g) - s.reg_alpha, 0.0), g)
        for n in nodes:
            n.value = -s.learning_rate * soft(n.g) / max(n.h + s.reg_lambda, 1e-300) if n.n else 0.0
        tree, _ = _as_tree(nodes, lambda n: n.split)
        return tree


# --- exact order statistics of residuals ------------------------------------

def _patterns(v: np.ndarray) -> np.ndarray:
    """Bit patterns of doubles, in the doubles' order."""
    u = (np.ascontiguousarray(v, np.float64) + 0.0).view(np.uint64)
    return np.where(u >> np.uint64(63), ~u, u | np.uint64(1 << 63))


def _double(p: int) -> float:
    u = p & ~(1 << 63) if p >> 63 else ~p & (1 << 64) - 1
    return float(np.array([u], np.uint64).view(np.float64)[0])


def order_statistics(state: DataFrame, values, groups: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """(smallest value that ``share`` of a group's rows don't exceed, rows) per group, exact.

    ``values(block)`` gives (value, group or -1) of the rows. Each job settles DIGIT bits of all groups.
    """
    prefix, rank, rows, done = [0] * groups, None, None, 0
    while done < 64:
        bits = min(DIGIT, 64 - done)
        known, rest = np.array(prefix, np.uint64), 64 - done - bits

        def count(b):
            v, g = values(b)
            p = _patterns(v)
            on = g >= 0
            if done:  # noqa: B023
                on &= (p >> np.uint64(64 - done)) == known[np.maximum(g, 0)]  # noqa: B023
            digit = ((p[on] >> np.uint64(rest)) & np.uint64((1 << bits) - 1)).astype(np.int64)  # noqa: B023
            return np.bincount(g[on] * (1 << bits) + digit, minlength=groups << bits).astype(np.float64)  # noqa: B023
        c = sum_arrays(state, count, np.uint8, groups << bits).reshape(groups, 1 << bits)
        if rank is None:
            rows = c.sum(axis=1)
            rank = np.maximum(np.ceil(share * rows - 1e-9), 1)
        up = np.cumsum(c, axis=1)
        for i in range(groups):
            if rows[i]:
                k = int(np.searchsorted(up[i], rank[i]))
                rank[i] -= up[i, k - 1] if k else 0
                prefix[i] = prefix[i] << bits | k
        done += bits
    return np.array([_double(p) if n else 0.0 for p, n in zip(prefix, rows)]), rows


def _huber_leaves(state, tree: Tree, trees, bend: float, s: Settings, leave_out, tree_no: int) -> Tree:
    """The tree with each leaf's value: median of its residuals, plus the mean of the clipped deviations from it."""
    k, out = len(tree.value), -2 if leave_out is None else leave_out

    def residual(b):
        use = (b.fold != out) & (_sampled(b, s.subsample, s.seed, tree_no) > 0)
        return b.y - _margin(b, trees), np.where(use, tree.leaf(b.x), -1)
    median, _ = order_statistics(state, residual, k, 0.5)

    def deviation(b):
        r, leaf = residual(b)
        r, leaf = r[leaf >= 0], leaf[leaf >= 0]
        return np.concatenate([np.bincount(leaf, np.clip(r - median[leaf], -bend, bend), k), np.bincount(leaf, minlength=k)])
    a, n = sum_arrays(state, deviation, np.uint8).reshape(2, k)
    return Tree(tree.feature, tree.cut, tree.left, tree.right, s.learning_rate * (median + a / np.maximum(n, 1)), tree.depth)


# --- model ------------------------------------------------------------------

class HistogramBoostingModel(StateModel):
    """Trees over raw features; adds ``prediction`` and, for classification, ``probability`` of class 1."""

    def __init__(self, features=None, base: float = 0.0, trees=(), loss: str = "logistic", gains=None, history=None):
        super().__init__(None if features is None else {
            "features": features, "base": base, "loss": loss, "gains": gains, "history": history,
            "trees": [{k: (float if k in ("cut", "value") else int)(v) if k == "depth" else [x.item() for x in v] for k, v in t.items()} for t in trees]})

    @property
    def featureImportances(self):
        from pyspark.ml.linalg import Vectors
        g = np.array(self.learned["gains"])
        return Vectors.dense(g / g.sum() if g.sum() > 0 else g)

    @property
    def n_trees(self) -> int:
        return len(self.learned["trees"])

    @property
    def history(self) -> list[float]:
        """Mean loss of the left-out rows before each tree."""
        return self.learned["history"]

    def _transform(self, df: DataFrame) -> DataFrame:
        a = self.learned
        trees = [Tree(*(np.array(t[k]) for k in ("feature", "cut", "left", "right", "value")), t["depth"]) for t in a["trees"]]
        base = a["base"]

        @F.arrow_udf("double")
        def margin(x):
            import pyarrow as pa
            v = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) if len(x) else np.zeros((0, 1))
            m = np.full(len(v), base)
            for t in trees:
                m = m + t.value[t.leaf(v)]
            return pa.array(m)
        out = df.withColumn("_m", margin(features_column(df, a["features"])))
        if a["loss"] != "logistic":
            return out.withColumnRenamed("_m", "prediction")
        return out.withColumn("prediction", (F.col("_m") > 0).cast("double")).withColumn("probability", 1.0 / (1.0 + F.exp(-F.col("_m")))).drop("_m")


def fit_boosting(df: DataFrame, features="features", label: str = "label", *, fold_col: str | None = None, leave_out: int | None = None,
                 edges: list | None = None, **settings) -> HistogramBoostingModel:
    """``Settings`` as keywords. Rows whose ``fold_col`` equals ``leave_out`` are only watched (``early_stopping`` trees without gain end the growth)."""
    s = Settings(**settings)
    if s.loss not in ("logistic", "squared", "huber"):
        raise ValueError(f"loss {s.loss!r}: logistic, squared or huber")
    if not 2 <= s.max_bins <= 256:
        raise ValueError("max_bins must be 2 to 256")
    if s.early_stopping and leave_out is None:
        raise ValueError("early_stopping needs leave_out")
    blocks = pack(df, features, label, None, fold_col)
    first = blocks.select((F.octet_length("x") / F.col("n") / 8).cast("int")).first()
    if first is None:
        raise ValueError("no complete rows to fit on")
    width = first[0]
    edges = [np.asarray(e, float) for e in edges] if edges is not None else bin_edges(df, features, width, s.max_bins)
    bins, out = max(len(e) for e in edges) + 1, -2 if leave_out is None else leave_out
    n, ones, total = sum_arrays(blocks, lambda b: np.array([(b.fold != out).sum(), (b.y[b.fold != out] > 0).sum(), b.y[b.fold != out].sum()]))
    if not n:
        raise ValueError("no complete rows to fit on")
    base = math.log(max(ones, 0.5) / max(n - ones, 0.5)) if s.loss == "logistic" else total / n
    state = _binned(blocks, edges, base)
    if s.loss == "huber":
        base = float(order_statistics(state, lambda b: (b.y, np.where(b.fold != out, 0, -1)), 1, 0.5)[0][0])
        release(state)
        state = _binned(blocks, edges, base)
    release(blocks)
    trees: list[Tree] = []
    fresh: list[Tree] = []
    gains, history = np.zeros(width), []
    grower = _Grower(state, s, bins, width)

    def keep_going(head) -> bool:
        history.append(head[0] / head[1] if head[1] else None)
        return not s.early_stopping or history[0] is None or len(history) - 1 - int(np.argmin(history)) < s.early_stopping

    for k in range(s.n_estimators):
        if len(fresh) == CUT:
            spent, grower.state, fresh = grower.state, _advance(grower.state, fresh), []
            release(spent)
        bend = math.inf
        if s.loss == "huber":
            now = list(fresh)
            bend = float(order_statistics(grower.state, lambda b: (np.abs(b.y - _margin(b, now)), np.where(b.fold != out, 0, -1)),  # noqa: B023
                                          1, s.huber_alpha)[0][0])
        tree = grower.grow(list(fresh), k, bend, leave_out, keep_going)
        if tree is None or (tree.depth == 0 and s.loss != "huber" and s.subsample >= 1 and s.colsample >= 1):
            break                                              # stopped early, or no split gains anything: later trees neither
        if s.loss == "huber":
            tree = _huber_leaves(grower.state, tree, list(fresh), bend, s, leave_out, k)
        trees.append(tree)
        fresh.append(tree)
        np.add.at(gains, tree.feature[tree.feature >= 0], 1.0)
    if s.early_stopping and len(history) == len(trees):          # the last tree's loss
        a = sum_arrays(grower.state, lambda b: np.array([loss_sum(s.loss, b.y[b.fold == out], _margin(b, fresh)[b.fold == out], math.inf),
                                                         (b.fold == out).sum()]), np.uint8)
        history.append(a[0] / a[1] if a[1] else None)
    if s.early_stopping and history[0] is not None:
        trees = trees[:int(np.argmin(history[:len(trees) + 1]))]
    release(grower.state)
    raw = []
    for t in trees:
        cut = np.array([edges[f][c] if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut)])
        raw.append({"feature": t.feature, "cut": cut, "left": t.left, "right": t.right, "value": t.value, "depth": t.depth})
    model = HistogramBoostingModel(features, float(base), raw, s.loss, gains.tolist(), history)
    model.jobs = grower.jobs
    return model


class HistogramBoosting(FitEstimator):
    """``HistogramBoosting(features=..., label=..., **settings)`` as an ``ml`` estimator."""

    def _fit(self, df: DataFrame) -> HistogramBoostingModel:
        return fit_boosting(df, **self.options)
