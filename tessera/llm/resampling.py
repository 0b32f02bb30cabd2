"""Importance resampling towards a target distribution over hashed n-gram features.

Features are all runs of one to three consecutive words; a feature's bucket is
the CRC-32 of its bytes modulo ``buckets``. A CRC is linear: that of two
strings together is the first one's state moved on by the second one's length,
plus the second one's CRC. So a run's CRC comes from the states of its words
without building its bytes:

* **Head.** Frequent words and pairs (counted over both tables) are broadcast:
  each word's exact CRC state, each pair's state and bucket. Their number is
  bounded by ``HEAD_WORDS`` and ``HEAD_PAIRS``; which words are in the head
  changes no result.
* **Tail.** A word the head doesn't hold takes its CRC from its bytes, a pair
  that it doesn't hold from its two words; triples follow from pairs.

Both feed the same exact bucket totals: one array per task, summed by Spark.
The gains (one number per bucket) go to the second pass over the texts, which
sums them per document. The draw adds Gumbel noise from the id's SHA-256; the
rows that may be drawn are found from a histogram of the scores, and only
these are sorted.

Head entries are found by 64-bit fingerprints of the words.

Defined results: null and empty texts have no features and weight 0; a null id
hashes like an empty one and comes last in ties; repeated rows are scored each
and tie by place; an empty table gives no rows, an empty target gains from an
even spread; whole texts are read.
"""

from __future__ import annotations

import functools
import math
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import global_position
from .lookup import SortedHashes
from .store import materialise
from .text import ALNUM, LOWER, Words, chunks, mix, ngram_hashes

#: entries of the head at most: 16 and 20 bytes each
HEAD_WORDS, HEAD_PAIRS = 1 << 16, 1 << 17
#: distinct words or pairs a task counts before it drops the rare ones from the race for the head
RACE = 1 << 20
#: words up to so many bytes take the vectorised CRC
SHORT = 64
BUCKETS = 10_000
SPACE = 32


# --- CRC-32 as a linear map -------------------------------------------------

@functools.cache
def byte_table() -> np.ndarray:
    """The CRC-32 register after one byte (reflected polynomial 0xEDB88320)."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> np.uint32(1)) ^ np.where(t & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return t


def zero_byte(c: np.ndarray) -> np.ndarray:
    return byte_table()[c & np.uint32(255)] ^ (c >> np.uint32(8))


def _apply(tables: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map given as the images of the four bytes' values."""
    out = tables[0][c & np.uint32(255)]
    for k in range(1, 4):
        out = out ^ tables[k][(c >> np.uint32(8 * k)) & np.uint32(255)]
    return out


@functools.cache
def short_shifts() -> np.ndarray:
    """Maps of n zero bytes for n up to SHORT, flattened: (n, byte of the register, its value)."""
    t = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    out = [t]
    for _ in range(SHORT):
        out.append(zero_byte(out[-1]))
    return np.stack(out).ravel()


@functools.cache
def power_shift(bit: int) -> np.ndarray:
    """Map of 2**bit zero bytes."""
    t = short_shifts().reshape(SHORT + 1, 4, 256)
    if 1 << bit <= SHORT:
        return t[1 << bit]
    half = power_shift(bit - 1)
    return _apply(half, half)


def shift(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRCs moved on by n bytes each."""
    t, base = short_shifts(), np.minimum(n, SHORT) * 1024
    out = t[base + (c & np.uint32(255))]
    for k in range(1, 4):
        out = out ^ t[base + 256 * k + ((c >> np.uint32(8 * k)) & np.uint32(255))]
    far = np.flatnonzero(n > SHORT)
    if len(far):
        x, m = out[far], n[far] - SHORT
        for bit in range(int(m.max()).bit_length()):
            on = (m >> bit) & 1 == 1
            x[on] = _apply(power_shift(bit), x[on])
        out[far] = x
    return out


def and_space(c: np.ndarray) -> np.ndarray:
    """CRCs of the same strings with a space behind."""
    return ~(byte_table()[(~c ^ np.uint32(SPACE)) & np.uint32(255)] ^ (~c >> np.uint32(8)))


def crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte ranges."""
    out = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    lens, t = ends - starts, byte_table()
    live = np.flatnonzero(lens <= SHORT)
    for j in range(SHORT):
        live = live[lens[live] > j]
        if not len(live):
            break
        c = out[live]
        out[live] = t[(c ^ data[starts[live] + j]) & np.uint32(255)] ^ (c >> np.uint32(8))
    out = ~out
    for i in np.flatnonzero(lens > SHORT).tolist():
        out[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes())
    return out


# --- features of a chunk of texts -------------------------------------------

class Head:
    """Broadcast head: states of frequent words, states and buckets of frequent pairs."""

    def __init__(self, words: np.ndarray, word_crc: np.ndarray, pairs: np.ndarray, pair_crc: np.ndarray, buckets: int):
        self.buckets = buckets
        self.words, self.pairs = SortedHashes(words), SortedHashes(pairs)
        self.word_crc = word_crc.astype(np.uint32)[self.words.order]
        self.pair_crc = pair_crc.astype(np.uint32)[self.pairs.order]
        self.pair_bucket = (self.pair_crc % np.uint32(buckets)).astype(np.int64)


def word_states(w: Words, lower: np.ndarray, head: Head | None) -> np.ndarray:
    """CRC of every word: from the head, else from its bytes."""
    if head is None or not head.words.n:
        return crcs(lower, w.starts, w.ends)
    at = head.words.find(w.hashes())
    out = head.word_crc[at]
    tail = np.flatnonzero(at < 0)
    out[tail] = crcs(lower, w.starts[tail], w.ends[tail])
    return out


def run_buckets(w: Words, lower: np.ndarray, head: Head | None, buckets: int):
    """(bucket of the word, of the pair, of the triple) that starts at each word; -1 where the text ends before."""
    n = len(w.starts)
    one = word_states(w, lower, head)
    lens = w.ends - w.starts
    left = np.repeat(w.first[1:], w.counts()) - np.arange(n)              # words of the text from here on
    out = [(one % np.uint32(buckets)).astype(np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)]
    i = np.flatnonzero(left >= 2)
    two = np.zeros(n, np.uint32)
    tail = i
    if head is not None and head.pairs.n and len(i):
        at = head.pairs.find(ngram_hashes(w.hashes(), 2)[i])
        known = at >= 0
        two[i[known]] = head.pair_crc[at[known]]
        out[1][i[known]] = head.pair_bucket[at[known]]
        tail = i[~known]
    two[tail] = shift(and_space(one[tail]), lens[tail + 1]) ^ one[tail + 1]
    out[1][tail] = two[tail] % np.uint32(buckets)
    i = np.flatnonzero(left >= 3)
    out[2][i] = (shift(and_space(two[i]), lens[i + 2]) ^ one[i + 2]) % np.uint32(buckets)
    return out


def _chunks(batch, column):
    for lo, hi, data, offs in chunks(batch.column(column)):
        yield lo, hi, Words(data, offs, ALNUM), LOWER[data]


# --- head -------------------------------------------------------------------

class _Race:
    """Counts of hashes with their CRC; beyond RACE distinct ones the rarer half leaves."""

    def __init__(self):
        self.h, self.crc, self.n = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def add(self, h, crc):
        u, first, n = np.unique(h, return_index=True, return_counts=True)
        allh = np.concatenate([self.h, u])
        s, at, inv = np.unique(allh, return_index=True, return_inverse=True)
        self.crc = np.concatenate([self.crc, crc[first]])[at]
        self.n = np.bincount(inv, np.concatenate([self.n, n]), len(s)).astype(np.int64)
        self.h = s
        if len(s) > RACE:
            self._keep(RACE // 2)

    def _keep(self, m):
        if len(self.h) > m:
            top = np.sort(np.lexsort((self.h, -self.n))[:m])
            self.h, self.crc, self.n = self.h[top], self.crc[top], self.n[top]

    def best(self, m):
        self._keep(m)
        often = self.n > 1
        return self.h[often], self.crc[often], self.n[often]


def _race_batch(words: int, pairs: int):
    import pyarrow as pa

    def run(batches):
        race = [_Race(), _Race()]
        for batch in batches:
            for _, _, w, lower in _chunks(batch, "_text"):
                if not len(w.starts):
                    continue
                h, one = w.hashes(), word_states(w, lower, None)
                race[0].add(h, one)
                left = np.repeat(w.first[1:], w.counts()) - np.arange(len(h))
                i = np.flatnonzero(left >= 2)
                if len(i):
                    two = shift(and_space(one[i]), (w.ends - w.starts)[i + 1]) ^ one[i + 1]
                    race[1].add(ngram_hashes(h, 2)[i], two)
        for kind, m in ((0, words), (1, pairs)):
            h, crc, n = race[kind].best(m)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), kind, np.int32)), pa.array(h.view(np.int64)),
                                              pa.array(crc.astype(np.int64)), pa.array(n)], names=["kind", "h", "crc", "n"])
    return run


def frequent(texts: DataFrame, words: int = HEAD_WORDS, pairs: int = HEAD_PAIRS, buckets: int = BUCKETS) -> Head:
    """The head of a table with column ``_text``: at most ``words`` + ``pairs`` entries reach the driver."""
    part = texts.mapInArrow(_race_batch(words, pairs), "kind int, h long, crc long, n long")
    total = materialise(part.groupBy("kind", "h", "crc").agg(F.sum("n").alias("n"))
                        .withColumn("often", F.floor(16 * F.log2("n")).cast("int")))
    hist = total.groupBy("kind", "often").agg(F.count(F.lit(1)).alias("m")).collect()      # 16 * 64 steps a kind at most
    found = []
    for kind, most in ((0, words), (1, pairs)):
        least, m = None, 0
        for r in sorted((r for r in hist if r["kind"] == kind), key=lambda r: -r["often"]):
            m += r["m"]
            if m > most:
                break
            least = r["often"]
        if least is None:
            found += [np.zeros(0, np.uint64), np.zeros(0, np.uint32)]
            continue
        t = total.where((F.col("kind") == kind) & (F.col("often") >= least)).select("h", "crc").toPandas()
        found += [t["h"].to_numpy(np.int64).view(np.uint64), t["crc"].to_numpy(np.int64).astype(np.uint32)]
    return Head(*found, buckets)


# --- totals and weights -----------------------------------------------------

def _totals_batch(value):
    import pyarrow as pa

    def run(batches):
        head = value()
        total = np.zeros(head.buckets + 1, np.int64)                       # the last place takes the runs that end early
        for batch in batches:
            for _, _, w, lower in _chunks(batch, "_text"):
                for b in run_buckets(w, lower, head, head.buckets):
                    total += np.bincount(np.where(b < 0, head.buckets, b), minlength=head.buckets + 1)
        b = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(b.astype(np.int32)), pa.array(total[b])], names=["bucket", "n"])
    return run


def bucket_totals(texts: DataFrame, head) -> np.ndarray:
    """Exact number of features per bucket; one row per bucket reaches the driver."""
    out = np.zeros(head.value.buckets, np.int64)
    part = texts.mapInArrow(_totals_batch(lambda: head.value), "bucket int, n long")
    for r in part.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1)(S + B) / ((s + 1)(T + B)))) per bucket."""
    b = len(source)
    s_all, t_all = float(source.sum() + b), float(target.sum() + b)
    return np.array([math.floor(1000 * math.log(float(t + 1) * s_all / (float(s + 1) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weights_batch(value, gain: np.ndarray):
    import pyarrow as pa
    gain = np.append(gain, 0)                                              # place -1: no feature

    def run(batches):
        head = value()
        for batch in batches:
            for lo, hi, w, lower in _chunks(batch, "_text"):
                per = sum(gain[b] for b in run_buckets(w, lower, head, head.buckets))
                run_ = np.concatenate(([0], np.cumsum(per)))
                n = w.counts()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(lo, hi - lo), pa.array(n.astype(np.int64)),
                     pa.array((np.maximum(n, 0) + np.maximum(n - 1, 0) + np.maximum(n - 2, 0)).astype(np.int64)),
                     pa.array(run_[w.first[1:]] - run_[w.first[:-1]])], names=["_id", "n_words", "n_features", "weight"])
    return run


def _texts(df: DataFrame, text_col: str) -> DataFrame:
    return df.select(F.col(f"`{text_col}`").alias("_text"))


def weights(docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
            head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """(_id, n_words, n_features, weight) of every row of ``docs``."""
    both = _texts(docs, text_col).union(_texts(target, text_col))
    head = docs.sparkSession.sparkContext.broadcast(frequent(both, head_words, head_pairs, buckets))
    gain = gains(bucket_totals(_texts(docs, text_col), head), bucket_totals(_texts(target, text_col), head))
    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    return src.mapInArrow(_weights_batch(lambda: head.value, gain), "_id long, n_words long, n_features long, weight long")


# --- draw -------------------------------------------------------------------

def gumbel(doc_id, seed: int = 42):
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of SHA-256(seed:id)."""
    h = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(h, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(u)))


#: steps of the histogram of scores
STEPS = 1 << 14


def draw(scored: DataFrame, *, share: tuple[int, int] = (5, 100), min_words: int = 20) -> DataFrame:
    """Adds ``rank`` (1, 2, ...) to the rows with the highest ``score``; ties to the smaller _id, then by place.

    The number drawn is ``share`` of the rows with ``min_words`` words. A histogram of at most
    ``STEPS`` rows finds the score below which nothing is drawn; only rows above are sorted.
    """
    rows = materialise(scored.withColumn("_row", F.monotonically_increasing_id()))
    fit = rows.where(F.col("n_words") >= min_words)
    s = fit.agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    take = share[0] * s["n"] // share[1]
    if not take:
        return rows.withColumn("rank", F.lit(None).cast("long")).drop("_row")
    step = -(-(s["hi"] - s["lo"] + 1) // STEPS)
    bin_ = F.expr(f"(score - ({s['lo']}L)) div {step}L")
    least, seen = s["lo"], 0
    for r in sorted(fit.groupBy(bin_.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["b"]):
        seen += r["n"]
        if seen >= take:
            least = s["lo"] + int(r["b"]) * step
            break
    near = (F.col("n_words") >= min_words) & (F.col("score") >= least)
    order = {"_down": -F.col("score"), "_none": F.col("_id").isNull()}
    top = global_position(rows.where(near).withColumns(order), ["_down", "_none", "_id", "_row"])
    top = top.withColumn("rank", F.when(F.col("_pos") < take, F.col("_pos") + 1)).drop("_pos", "_down", "_none")
    return top.unionByName(rows.where(~near).withColumn("rank", F.lit(None).cast("long"))).drop("_row")


def resample(docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", seed: int = 42, share: tuple[int, int] = (5, 100),
             min_words: int = 20, **options) -> DataFrame:
    """One row per document row: id, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank`` (null: not drawn)."""
    w = weights(docs, target, doc_id=doc_id, **options)
    scored = w.withColumn("score", (F.col("weight") + gumbel(F.col("_id"), seed)).cast("long"))
    return draw(scored, share=share, min_words=min_words).withColumnRenamed("_id", doc_id)
