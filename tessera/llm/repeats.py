"""Removal of long repeated byte strings: a sampled suffix array refined by bucket identifiers.

Every window of ``width`` (400) bytes that starts at two places is found, and
its bytes removed. Sorting all suffixes of the corpus would shuffle many times
the input, so only sampled suffixes are refined:

* **Initial buckets.** Of each window the leftmost smallest ``q``-gram (by
  fingerprint) is its anchor; neighbouring windows share anchors, so about one
  position in 140 is sampled. Equal windows have equal anchors at equal
  offsets, so windows can only be equal inside one q-gram bucket, at one offset.
* **Refinement by later offsets.** A bucket's members are split by the
  identifier of the longer stretch around the anchor. The identifier of a
  stretch is made of the identifiers of its parts at two offsets (pair of
  fingerprints, as in prefix doubling); members in the same refined bucket are
  represented by one of them in later rounds, so each update is reused:
  1. the stretch of all windows an anchor has (``hull``): equal hulls -> all
     windows repeat;
  2. blocks of ``STEP`` window starts: equal hulls -> all repeat; a core (the
     bytes common to all windows of the block) that stands nowhere else -> none
     does;
  3. the single windows of the blocks still open.

Each round is a count per refined bucket (partially aggregated) joined back to
its members; no bucket is gathered in a task, whatever its size. Texts are
shuffled once, compressed, into a checkpoint partitioned by row, so that each
round only shuffles positions.

Fingerprints are 64 bits, compared together with the bucket's own 64 bits.

Defined results: a null or empty text has 0 bytes and the hash of nothing;
repeated rows are separate texts (their common strings are repeats); strings
never cross texts; other columns are not touched.
"""

from __future__ import annotations

import functools
import hashlib
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .store import free, materialise, tidy
from .text import _TABLE, U, buffers, mix, powers

Q = 128
STEP = 16


class _Prints:
    """Fingerprints of byte ranges of one buffer."""

    def __init__(self, data: np.ndarray):
        p, self.inv = powers(len(data) + 1)
        self.s = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * p[:len(data)], out=self.s[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.s[b] - self.s[a]) * self.inv[a] + (b - a).astype(np.uint64))

    def pair(self, a: np.ndarray, mid: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Identifier of [a, b) from the identifiers of [a, mid) and [mid, b)."""
        return mix(self.of(a, mid) * U(0x9E3779B97F4A7C15) + self.of(mid, b))


def anchors(data: np.ndarray, width: int, q: int = Q):
    """(anchor, first window, last window, bucket, prints) of one text: every window start belongs to one anchor."""
    n = len(data) - width + 1
    prints = _Prints(data)
    i = np.arange(len(data) - q + 1)
    v = prints.of(i, i + q)
    w = width - q + 1
    # smallest value with the position below it: the leftmost of equal ones wins
    bits = U(max(1, int(len(data)).bit_length()))
    key = ((v >> bits) << bits) | i.astype(np.uint64)
    pad = (-len(key)) % w
    blocks = np.concatenate([key, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    pos = (np.minimum(behind[:n], ahead[w - 1:w - 1 + n]) & ((U(1) << bits) - U(1))).astype(np.int64)
    lo = np.flatnonzero(np.concatenate(([True], pos[1:] != pos[:-1])))
    hi = np.concatenate((lo[1:], [n])) - 1
    a = pos[lo]
    return a, lo, hi, v[a], prints


def _texts(batch, column):
    data, offs = buffers(batch.column(column))
    raw = data.tobytes()
    for i in range(len(offs) - 1):
        yield i, np.frombuffer(zlib.decompress(raw[offs[i]:offs[i + 1]]), np.uint8)


def _pack(batches):
    import pyarrow as pa
    for batch in batches:
        data, offs = buffers(batch.column("_text"))
        raw = data.tobytes()
        blobs = [zlib.compress(raw[offs[i]:offs[i + 1]], 1) for i in range(len(offs) - 1)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("_id"), pa.array(blobs, pa.binary())],
                                         names=["row", "_id", "blob"])


def _rows(parts, names, types):
    import pyarrow as pa
    cols = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(len(names))]
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(t)).cast(t2)
                                       for c, (t, t2) in zip(cols, types)], names=names)


_L, _I = ("int64", "int64"), ("int32", "int32")


def _anchor_batch(width):
    def run(batches):
        for batch in batches:
            ids, parts, size = batch.column("row").to_numpy(), [], 0
            for i, data in _texts(batch, "blob"):
                if len(data) < width:
                    continue
                a, lo, hi, h, prints = anchors(data, width)
                hull = prints.pair(lo, a, hi + width)
                hull = mix(hull + (a - lo).astype(np.uint64) * U(1 << 20) + (hi - lo).astype(np.uint64))
                parts.append((np.full(len(a), ids[i]), a, lo, hi, h, hull))
                size += len(a)
                if size > 200_000:
                    yield _rows(parts, _ANCHOR, [_L, _I, _I, _I, _L, _L])
                    parts, size = [], 0
            yield _rows(parts, _ANCHOR, [_L, _I, _I, _I, _L, _L])
    return run


_ANCHOR = ["row", "a", "lo", "hi", "h", "hull"]


def _block_batch(width, step):
    """Blocks of window starts of the wanted anchors: offset x = anchor - start, block = x // step."""
    def run(batches):
        for batch in batches:
            ids, want, parts = batch.column("row").to_numpy(), batch.column("want").to_pylist(), []
            for i, data in _texts(batch, "blob"):
                prints = _Prints(data)
                a, lo, hi, h = (np.array([w[c] for w in want[i]], np.int64) for c in ("a", "lo", "hi", "h"))
                j0, j1 = (a - hi) // step, (a - lo) // step
                k = np.repeat(np.arange(len(a)), j1 - j0 + 1)
                j = np.arange(len(k)) - np.repeat(np.cumsum(j1 - j0 + 1) - (j1 - j0 + 1), j1 - j0 + 1) + j0[k]
                first = np.maximum(a[k] - (j * step + step - 1), lo[k])    # window starts of the block
                last = np.minimum(a[k] - j * step, hi[k])
                mid = a[k]
                hull = mix(prints.pair(first, mid, last + width) + (mid - first).astype(np.uint64) * U(1 << 20)
                           + (last - first).astype(np.uint64))
                core = prints.pair(np.minimum(a[k] - j * step, mid), mid, a[k] - (j * step + step - 1) + width)
                parts.append((np.full(len(k), ids[i]), first, last, a[k], h[k], j, hull, core))
            yield _rows(parts, _BLOCK, [_L, _I, _I, _I, _L, _I, _L, _L])
    return run


_BLOCK = ["row", "lo", "hi", "a", "h", "j", "hull", "core"]


def _window_batch(width):
    def run(batches):
        for batch in batches:
            ids, want, parts = batch.column("row").to_numpy(), batch.column("want").to_pylist(), []
            for i, data in _texts(batch, "blob"):
                prints = _Prints(data)
                a, lo, hi, h = (np.array([w[c] for w in want[i]], np.int64) for c in ("a", "lo", "hi", "h"))
                n = hi - lo + 1
                k = np.repeat(np.arange(len(a)), n)
                p = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n) + lo[k]
                parts.append((np.full(len(k), ids[i]), p, a[k] - p, h[k], prints.pair(p, a[k], p + width)))
            yield _rows(parts, _WINDOW, [_L, _I, _I, _L, _L])
    return run


_WINDOW = ["row", "lo", "x", "h", "hull"]


def _cover_batch(width):
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            spans, out = batch.column("spans").to_pylist(), []
            for i, data in _texts(batch, "blob"):
                n, s = len(data), spans[i] or []
                gone = np.zeros(n + 1, np.int32)
                if s:
                    np.add.at(gone, [x["lo"] for x in s], 1)
                    np.add.at(gone, [x["hi"] + width for x in s], -1)
                cover = np.cumsum(gone[:n]) > 0
                starts = np.flatnonzero(cover & ~np.concatenate(([False], cover[:-1]))) if n else np.zeros(0, np.int64)
                ends = np.flatnonzero(cover & ~np.concatenate((cover[1:], [False]))) + 1 if n else np.zeros(0, np.int64)
                rest = data[~cover].tobytes()
                out.append((n, int(cover.sum()), len(starts), hashlib.sha256(rest).hexdigest(), rest, starts.tolist(), ends.tolist()))
            cols = list(zip(*out)) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.string()), pa.array(cols[4], pa.binary()),
                 pa.array(cols[5], pa.list_(pa.int64())), pa.array(cols[6], pa.list_(pa.int64()))],
                names=["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "starts", "ends"])
    return run


def _wanted(rows: DataFrame) -> DataFrame:
    """Positions wanted of each text, as one list per text (bounded by the text's own length)."""
    return rows.groupBy("row").agg(F.collect_list(F.struct("a", "lo", "hi", "h")).alias("want"))


def _twice(rows: DataFrame, keys: list[str], mark: str) -> DataFrame:
    """Rows whose key stands at least twice, with ``mark`` true; others with false."""
    c = materialise(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").drop("_c"))
    return rows.join(c.withColumn(mark, F.lit(True)), keys, "left").withColumn(mark, F.coalesce(mark, F.lit(False)))


def repeated_windows(packed: DataFrame, width: int) -> DataFrame:
    """(row, lo, hi): window starts lo..hi all repeat somewhere else. ``packed``: see ``pack``.

    A table is deleted once the tables made from it are written.
    """
    rows = materialise(packed.select("row", "blob").mapInArrow(
        _anchor_batch(width), "row long, a int, lo int, hi int, h long, hull long"))
    b = rows.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("hull").alias("h0"), F.max("hull").alias("h1")).where("c > 1")
    # written first: both sides of the join are then plain exchanges, whose hot buckets Spark can split
    b = materialise(b.select("h", (F.col("h0") == F.col("h1")).alias("same")))
    live = materialise(rows.join(b, "h"))
    free(rows, b)
    whole = [materialise(live.where("same").select("row", "lo", "hi"))]
    # buckets of several refined identifiers: one member stands for each identifier
    mixed = live.where("not same")
    me = F.struct("row", "a")
    c = materialise(mixed.groupBy("h", "hull").agg(F.count(F.lit(1)).alias("c"), F.min(me).alias("rep")))
    mixed = materialise(mixed.join(c, ["h", "hull"]).select("row", "a", "lo", "hi", "h", (F.col("c") > 1).alias("twice"),
                                                            (me == F.col("rep")).alias("rep")))
    free(live, c)
    whole.append(materialise(mixed.where("twice").select("row", "lo", "hi")))
    blocks = materialise(_wanted(mixed.where("rep")).join(packed.select("row", "blob"), "row").mapInArrow(
        _block_batch(width, STEP), "row long, lo int, hi int, a int, h long, j int, hull long, core long"))
    free(mixed)
    # a block whose core stands nowhere else holds no repeat; its blocks' hulls then need no count
    open_ = materialise(_twice(blocks, ["h", "j", "core"], "maybe").where("maybe"))
    free(blocks)
    c = materialise(open_.groupBy("h", "j", "hull").agg(F.count(F.lit(1)).alias("c"), F.min(me).alias("rep")))
    known = materialise(open_.join(c, ["h", "j", "hull"]).select(
        "row", "lo", "hi", "a", "h", "j", "core", (F.col("c") > 1).alias("twice"), (me == F.col("rep")).alias("rep")))
    free(open_, c)
    whole.append(materialise(known.where("twice").select("row", "lo", "hi")))
    # windows one by one: of blocks still open, and of one block of each refined bucket beside them
    left = known.where("not twice").select("h", "j", "core").distinct()
    last = known.where("rep").join(left, ["h", "j", "core"], "left_semi")
    wins = materialise(_wanted(last).join(packed.select("row", "blob"), "row").mapInArrow(
        _window_batch(width), "row long, lo int, x int, h long, hull long"))
    free(known)
    again = _twice(wins, ["h", "x", "hull"], "again").where("again")
    whole.append(materialise(again.select("row", "lo", F.col("lo").alias("hi"))))
    free(wins)
    return functools.reduce(DataFrame.union, whole)


def pack(docs: DataFrame, doc_id: str, text_col: str) -> DataFrame:
    """(row, _id, blob): compressed texts, partitioned and sorted by row, in the checkpoint folder."""
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").cast("long").alias("_id"),
                      F.col(f"`{text_col}`").alias("_text"))
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.sparkSession.sparkContext.defaultParallelism)
    p = src.mapInArrow(_pack, "row long, _id long, blob binary").repartition(n, "row").sortWithinPartitions("row")
    return cut_lineage(p)


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text", width: int = 400) -> DataFrame:
    """One row per document row: sizes, removed spans (``starts``, ``ends`` in bytes), the bytes ``kept`` and their SHA-256."""
    if width < 2 * Q:
        raise ValueError(f"width must be at least {2 * Q} bytes")
    packed = pack(docs, doc_id, text_col)
    spans = materialise(repeated_windows(packed, width).groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")))
    tidy(docs.sparkSession)
    out = packed.join(spans, "row", "left").select("_id", "blob", "spans").mapInArrow(
        _cover_batch(width), "_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, "
                             "starts array<long>, ends array<long>")
    return out.withColumnRenamed("_id", doc_id)
