"""Quality by n-gram perplexity under a modified Kneser-Ney model of the whole corpus.

**Counts.** Runs of ``order`` bytes (the last one predicted from those before;
a text starts after ``order - 1`` line feeds) are counted by Spark per language
and per half of the corpus: a text's CRC-32 says which half, so copies share one.
A run is packed into one integer, so the lower orders of the model follow from
the distinct runs (continuation counts) without reading texts again.

**Model.** Interpolated modified Kneser-Ney with three discounts per language,
half and order, from the counts of counts. Each run of one half gets its
probability under the *other* half's counts, with joins over distinct runs from
the lowest order upwards; so no text is scored by counts that it made itself.
The result is the surprisal of every run, in units of 2**-20 nats.

**Lookup.** The table of surprisals is broadcast as sorted hash arrays, in slices
of about ``MAX_RUNS`` rows (12 bytes each), and texts are scored where they are
read. With one slice a task looks every run up in it; with more it gathers the
distinct runs of the texts it holds, looks them up in one slice after the other
(one in memory at a time) and scores the texts by what it found. Beyond
``MAX_SLICES`` slices a text's distinct runs are joined with the table. All sum
integers, so they agree to the last bit.

**Bands.** A text's score is ln(surprisal per word), the logarithm of the
logarithm of its perplexity per word. Per language and length class (octaves of
``n_words / 50``) the quartiles of the scores of distinct texts that pass the
base rules give the band [q1 - width, q3 + width], where width is ``fence``
times the quartile distance and ``least_width`` at least. A class with fewer
than ``min_texts`` texts takes its language's band, a language with fewer has
none and its texts pass.

Defined results: null and empty texts have no words, no score and fail the base
rules; a null language is a language of its own; copies count once in bands and
are scored each; whole texts are read; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.order import join_null_safe
from .lookup import SortedHashes
from .store import free, materialise, tidy
from .text import NONSPACE, U, Words, _TABLE, buffers, chunks, mix, ngram_hashes, powers

ORDER = 5
#: rows of a broadcast slice of the surprisal table, slices and languages that may be broadcast
MAX_RUNS, MAX_SLICES, MAX_LANGUAGES = 4_000_000, 64, 4096
#: distinct runs a task gathers before it hands them on, bytes of text it holds to look up their runs together
GATHER, HOLD = 1 << 21, 1 << 25
UNIT = float(1 << 20)
FENCE, LEAST_WIDTH, MIN_TEXTS = 3.0, 0.05, 50
#: steps of a score in the histograms that give the quartiles
STEP = 1e-4
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
_START = ord("\n")


# --- runs of bytes ----------------------------------------------------------

def half(raw: bytes) -> int:
    """Which half of the corpus a text belongs to."""
    return zlib.crc32(raw) & 1


def packed_runs(data: np.ndarray, offs: np.ndarray, order: int) -> np.ndarray:
    """The run that ends at each byte, as an integer; bytes before a text's start are line feeds."""
    n = len(data)
    out = data.astype(np.uint64)
    place = np.arange(n) - np.repeat(offs[:-1], np.diff(offs))
    for k in range(1, order):
        before = np.empty(n, np.uint64)
        before[k:] = data[:max(n - k, 0)]
        before[place < k] = _START
        out |= before << U(8 * k)
    return out


def _groups(batch, lo, hi, data, offs, index: dict):
    """Number of (language, half) of each text; new ones are added to the index."""
    langs = batch.column("_lang").slice(lo, hi - lo).to_pylist()
    raw = data.tobytes()
    return np.array([index.setdefault((langs[i], half(raw[offs[i]:offs[i + 1]])), len(index)) for i in range(hi - lo)], np.uint64)


_RUNS = "lang string, half int, v long, n long"


def _runs_batch(order: int):
    import pyarrow as pa
    shift = U(8 * order)

    def run(batches):
        index: dict = {}
        keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out():
            names = list(index)
            g = (keys >> shift).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in names], pa.string()).take(pa.array(g)), pa.array(np.array([x[1] for x in names] or [0], np.int32)[g]),
                 pa.array((keys & ((U(1) << shift) - U(1))).view(np.int64)), pa.array(n)], names=["lang", "half", "v", "n"])
        for batch in batches:
            for lo, hi, data, offs in chunks(batch.column("_text")):
                g = _groups(batch, lo, hi, data, offs, index)
                v = packed_runs(data, offs, order) | (np.repeat(g, np.diff(offs)) << shift)
                u, c = np.unique(v, return_counts=True)
                k, inv = np.unique(np.concatenate([keys, u]), return_inverse=True)
                n = np.bincount(inv, np.concatenate([n, c]), len(k)).astype(np.int64)
                keys = k
                if len(keys) > GATHER or len(index) > MAX_LANGUAGES:
                    yield out()
                    index, keys, n = {}, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(keys):
            yield out()
    return run


def count_runs(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", order: int = ORDER) -> DataFrame:
    """(lang, half, v, n): how often each run stands in each half of each language."""
    if not 2 <= order <= 5:
        raise ValueError("order must be 2 to 5")               # a run and its group share 64 bits
    src = docs.select(F.col(f"`{lang_col}`").cast("string").alias("_lang"), F.col(f"`{text_col}`").alias("_text"))
    return src.mapInArrow(_runs_batch(order), _RUNS).groupBy("lang", "half", "v").agg(F.sum("n").alias("n"))


# --- model ------------------------------------------------------------------

def _discounts(level: DataFrame) -> DataFrame:
    """(lang, half, d1, d2, d3): modified Kneser-Ney discounts of one order."""
    n = level.groupBy("lang", "half").agg(*[F.sum((F.col("n") == i).cast("long")).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)])
    y = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)
    d = [F.when(F.col(f"n{i}") > 0, F.least(F.greatest(i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"), F.lit(0.1)), F.lit(float(i))))
         .otherwise(0.5 * i).alias(f"d{i}") for i in (1, 2, 3)]
    return n.select("lang", "half", *d)


def _estimates(level: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, half, v, rest: count less its discount), (lang, half, context, total, free: share left to the lower order)."""
    d = _discounts(level)
    cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    runs = join_null_safe(level, d, ["lang", "half"]).select("lang", "half", "v", F.greatest(F.col("n") - cut, F.lit(0.0)).alias("rest"))
    ones = [F.sum(x.cast("long")).alias(f"m{i}") for i, x in ((1, F.col("n") == 1), (2, F.col("n") == 2), (3, F.col("n") > 2))]
    ctx = level.groupBy("lang", "half", F.shiftright("v", 8).alias("context")).agg(F.sum("n").alias("total"), *ones)
    free = (F.col("d1") * F.col("m1") + F.col("d2") * F.col("m2") + F.col("d3") * F.col("m3")) / F.col("total")
    ctx = join_null_safe(ctx, d, ["lang", "half"]).select("lang", "half", "context", "total", free.alias("free"))
    return runs, ctx


def _swap(df: DataFrame) -> DataFrame:
    """Estimates of one half under the number of the other, whose texts they score."""
    return df.withColumn("half", 1 - F.col("half"))


def fit(runs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, half, v, s): surprisal of every run of a half under the other half's model, in 1 / UNIT nats."""
    levels = {order: materialise(runs)}
    for k in range(order - 1, 0, -1):
        levels[k] = materialise(levels[k + 1].groupBy("lang", "half", F.col("v").bitwiseAND((1 << 8 * k) - 1).alias("v"))
                                .agg(F.count(F.lit(1)).alias("n")))
    below = None
    for k in range(1, order + 1):
        rest, ctx = _estimates(levels[k])
        want = levels[k].select("lang", "half", "v", F.shiftright("v", 8).alias("context"))
        want = join_null_safe(want, _swap(rest), ["lang", "half", "v"], "left")
        want = join_null_safe(want, _swap(ctx), ["lang", "half", "context"], "left")
        if below is None:
            want = want.withColumn("q", F.lit(1.0 / 256))
        else:
            want = want.withColumn("low", F.col("v").bitwiseAND((1 << 8 * (k - 1)) - 1))
            want = join_null_safe(want, below.select("lang", "half", F.col("v").alias("low"), F.col("p").alias("q")), ["lang", "half", "low"])
        p = F.when(F.col("total").isNull(), F.col("q")).otherwise(
            F.coalesce("rest", F.lit(0.0)) / F.col("total") + F.col("free") * F.col("q"))
        spent, below = below, materialise(want.select("lang", "half", "v", p.alias("p")))
        free(levels[k], *([] if spent is None else [spent]))
    out = materialise(below.select("lang", "half", "v", F.round(-F.log("p") * UNIT).cast("int").alias("s")))
    free(below)
    return out


class Surprisals:
    """Sorted hash arrays of the model: the hash of (language and half, run) finds its surprisal."""

    def __init__(self, index: dict, groups: np.ndarray, v: np.ndarray, s: np.ndarray, order: int):
        self.index, self.order = index, order
        self.hashes = SortedHashes(mix(v.astype(np.uint64) | (groups.astype(np.uint64) << U(8 * order))))
        self.s = s.astype(np.int32)[self.hashes.order]
        self.hashes.order = None                                # not needed any more, not broadcast

    def of(self, groups: np.ndarray, v: np.ndarray) -> np.ndarray:
        return self.s[self.hashes.find(mix(v | (groups << U(8 * self.order))))]


def slice_of(v, n: int):
    """Which of ``n`` slices holds a run (an array or a column of runs)."""
    if isinstance(v, np.ndarray):
        v = v.astype(np.int64)
        return ((v & 0xFFFFF) * 0x9E3779B1 + (v >> 20) * 0x85EBCA6B >> 20) % n
    return F.shiftright(v.bitwiseAND(0xFFFFF) * 0x9E3779B1 + F.shiftright(v, 20) * 0x85EBCA6B, 20) % n


def share(model: DataFrame, order: int = ORDER, max_runs: int = MAX_RUNS) -> tuple[list, dict]:
    """The model's arrays as broadcast slices of about ``max_runs`` rows, and the numbers of (language, half).

    No slices if there would be more than MAX_SLICES, or more than MAX_LANGUAGES languages.
    """
    langs = [r[0] for r in model.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    rows = model.count()
    n = max(1, -(-rows // max_runs)) if max_runs > 0 else 1 + rows
    if len(langs) > MAX_LANGUAGES or n > MAX_SLICES:
        return [], {}
    code = F.lit(-1)
    for i, x in enumerate(langs):
        code = F.when(F.col("lang").eqNullSafe(F.lit(x)), i).otherwise(code) if len(langs) <= 64 else code
    if len(langs) > 64:                                          # a long CASE is slow: join the numbers instead
        names = model.sparkSession.createDataFrame([(x, i) for i, x in enumerate(langs)], "lang string, code int")
        model, code = join_null_safe(model, names, ["lang"]), F.col("code")
    index = {(x, h): 2 * i + h for i, x in enumerate(langs) for h in (0, 1)}
    out = []
    for i in range(n):                                           # the driver holds one slice at a time
        part = model if n == 1 else model.where(slice_of(F.col("v"), n) == i)
        t = part.select((2 * code + F.col("half")).cast("int").alias("g"), "v", "s").toArrow()
        arrays = Surprisals(index, *(t.column(c).to_numpy() for c in ("g", "v", "s")), order)
        del t
        out.append(model.sparkSession.sparkContext.broadcast(arrays))
    return out, index


def _loaded(shared):
    """A broadcast value that goes when its holder does (``value`` would stay with the worker)."""
    path = getattr(shared, "_path", None)
    return shared.value if path is None or hasattr(shared, "_value") else shared.load_from_path(path)


def of_slices(keys: np.ndarray, slices: list, order: int) -> Surprisals:
    """The surprisals of the runs ``keys`` (packed with their group) alone, from one slice after the other."""
    shift = U(8 * order)
    g, v = keys >> shift, keys & ((U(1) << shift) - U(1))
    s, at = np.zeros(len(keys), np.int32), slice_of(v, len(slices))
    for i, shared in enumerate(slices):
        mine = np.flatnonzero(at == i)
        if len(mine):
            s[mine] = _loaded(shared).of(g[mine], v[mine])
    return Surprisals({}, g, v, s, order)


# --- texts ------------------------------------------------------------------

def repeated(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Does the same (doc, hash) stand elsewhere too?"""
    _, inv, n = np.unique(mix(h + doc.astype(np.uint64) * U(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    return n[inv] > 1


def base_counts(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The base columns of a chunk's texts."""
    d, size = len(offs) - 1, len(data)
    w = Words(data, offs, NONSPACE)
    n = w.counts()
    doc = np.repeat(np.arange(d), n)
    # fingerprints of the bytes as they stand (no lower case)
    p, inv = powers(size + 1)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_TABLE[data] * p[:size], out=sums[1:])
    prints = lambda a, b: mix((sums[b] - sums[a]) * inv[a] + (b - a).astype(np.uint64))
    per = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[offs])
    chars = NONSPACE[data] & ((data & 0xC0) != 0x80)
    out = {"n_words": n, "word_chars": per(chars), "n_symbols": per(_SYMBOL[data])}
    # lines: from each line feed or text start to the next
    cut = np.unique(np.concatenate([offs[:-1][np.diff(offs) > 0], np.flatnonzero(data == _START) + 1]))
    cut = cut[cut < size]
    home = np.searchsorted(offs, cut, "right") - 1
    nl = np.append(np.flatnonzero(data == _START), size)
    end = np.minimum(nl[np.searchsorted(nl, cut)], offs[home + 1])
    real = np.searchsorted(w.starts, end) > np.searchsorted(w.starts, cut)
    cut, home, end = cut[real], home[real], end[real]
    key = mix(prints(cut, end) + home.astype(np.uint64) * U(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[first] = False
    out["n_dup_lines"] = np.bincount(home[again], minlength=d)
    # words in windows of three that stand twice
    cover = np.zeros(len(doc) + 3, np.int64)
    if len(doc) >= 3:
        i = np.flatnonzero(doc[2:] == doc[:-2])
        g = ngram_hashes(prints(w.starts, w.ends), 3)[i]
        i = i[repeated(doc[i], g)]
        np.add.at(cover, i, 1)
        np.add.at(cover, i + 3, -1)
    out["n_repeat_words"] = np.bincount(doc[np.cumsum(cover)[:len(doc)] > 0], minlength=d)
    return {k: v.astype(np.int64) for k, v in out.items()}


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _gathered(batches, index: dict, order: int):
    """([(batch, lo, hi, data, offs)], their distinct runs packed with their group) of as many texts as a task holds."""
    shift = U(8 * order)
    held, size, keys, fresh = [], 0, np.zeros(0, np.uint64), []
    for batch in batches:
        for lo, hi, data, offs in chunks(batch.column("_text")):
            held.append((batch, lo, hi, data, offs))
            size += len(data)
            g = _groups(batch, lo, hi, data, offs, index)
            fresh.append(np.unique(packed_runs(data, offs, order) | (np.repeat(g, np.diff(offs)) << shift)))
            if sum(map(len, fresh)) > max(len(keys), 1 << 18):  # merged when they have doubled
                keys, fresh = np.unique(np.concatenate([keys, *fresh])), []
            if size > HOLD or len(keys) > GATHER:
                yield held, np.unique(np.concatenate([keys, *fresh]))
                held, size, keys, fresh = [], 0, np.zeros(0, np.uint64), []
    if held:
        yield held, np.unique(np.concatenate([keys, *fresh]))


def _measure_batch(slices: list, index: dict, order: int):
    """Base columns, fingerprint and surprisal (null without a broadcast model) of each text."""
    import pyarrow as pa

    def one(batch, lo, hi, data, offs, model):
        m, raw = hi - lo, data.tobytes()
        cols = base_counts(data, offs)
        if model is None:
            total = pa.nulls(m, pa.int64())
        else:
            g = _groups(batch, lo, hi, data, offs, dict(index))
            s = model.of(np.repeat(g, np.diff(offs)), packed_runs(data, offs, order))
            total = pa.array(np.diff(np.concatenate(([0], np.cumsum(s, dtype=np.int64)))[offs]))
        print_ = [zlib.crc32(raw[offs[i]:offs[i + 1]]) << 32 | zlib.adler32(raw[offs[i]:offs[i + 1]]) for i in range(m)]
        return pa.RecordBatch.from_arrays(
            [batch.column("_row").slice(lo, m), batch.column("_id").slice(lo, m), batch.column("_lang").slice(lo, m),
             *[pa.array(cols[c]) for c in BASE], pa.array(np.array(print_, np.uint64).view(np.int64)), total],
            names=["_row", "_id", "lang", *BASE, "print", "surprisal"])

    def run(batches):
        if len(slices) < 2:
            model = slices[0].value if slices else None
            for batch in batches:
                for lo, hi, data, offs in chunks(batch.column("_text")):
                    yield one(batch, lo, hi, data, offs, model)
            return
        for held, keys in _gathered(batches, dict(index), order):
            model = of_slices(keys, slices, order)
            for part in held:
                yield one(*part, model)
    return run


def _own_runs_batch(order: int):
    """(row, language, half, run, times) of the distinct runs of each text."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            data, offs = buffers(batch.column("_text"))
            langs, raw = batch.column("_lang"), data.tobytes()
            for i in range(len(offs) - 1):
                part = data[offs[i]:offs[i + 1]]
                v, n = np.unique(packed_runs(part, np.array([0, len(part)]), order), return_counts=True)
                m = len(v)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").take(pa.array(np.full(m, i))), langs.take(pa.array(np.full(m, i))),
                     pa.array(np.full(m, half(raw[offs[i]:offs[i + 1]]), np.int32)), pa.array(v.view(np.int64)), pa.array(n.astype(np.int64))],
                    names=["_row", "lang", "half", "v", "n"])
    return run


def measure(docs: DataFrame, model: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            order: int = ORDER, max_runs: int = MAX_RUNS) -> DataFrame:
    """Per row: _id, lang, the base columns, ``print`` and ``score`` (null without words)."""
    tidy(docs.sparkSession)
    slices, index = share(model, order, max_runs)
    src = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(f"`{doc_id}`").cast("long").alias("_id"),
                      F.col(f"`{lang_col}`").cast("string").alias("_lang"), F.col(f"`{text_col}`").alias("_text"))
    if not slices:
        src = materialise(src)                                   # row numbers used twice
    fields = "_row long, _id long, lang string, " + ", ".join(f"{c} long" for c in BASE) + ", print long, surprisal long"
    out = src.mapInArrow(_measure_batch(slices, index, order), fields)
    if not slices:
        own = src.select("_row", "_lang", "_text").mapInArrow(_own_runs_batch(order), "_row long, lang string, half int, v long, n long")
        s = join_null_safe(own, model, ["lang", "half", "v"]).groupBy("_row").agg(F.sum(F.col("n") * F.col("s")).alias("surprisal"))
        out = out.drop("surprisal").join(s, "_row", "left")
    score = F.when(F.col("n_words") > 0, F.log(F.col("surprisal") / UNIT / F.col("n_words")))
    return out.withColumn("score", score).drop("_row", "surprisal")


# --- bands ------------------------------------------------------------------

def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def length_class():
    return F.floor(F.log2(F.greatest(F.col("n_words"), F.lit(50)) / 50.0) + 1e-9).cast("int")


def _quartiles(hist: DataFrame, groups: list[str]) -> DataFrame:
    """Lowest steps that reach a quarter and three quarters of the texts; ``m`` texts."""
    h = hist.groupBy(*groups, "step").agg(F.sum("n").alias("n"))
    up = Window.partitionBy(*groups).orderBy("step")             # a histogram: at most some 10**5 steps a group
    h = h.withColumn("below", F.sum("n").over(up)).withColumn("m", F.sum("n").over(Window.partitionBy(*groups)))
    at = lambda k: F.min(F.when(4 * F.col("below") >= k * F.col("m"), F.col("step")))
    return h.groupBy(*groups).agg(at(1).alias("q1"), at(3).alias("q3"), F.max("m").alias("m"))


def bands(scored: DataFrame, *, fence: float = FENCE, least_width: float = LEAST_WIDTH, min_texts: int = MIN_TEXTS) -> DataFrame:
    """(lang, size, low, high): accepted steps of the score per language and length class."""
    ok = scored.where(~base_failed() & F.col("score").isNotNull()).withColumn("size", length_class())
    step = F.floor(F.col("score") / STEP).cast("long").alias("step")
    hist = materialise(ok.select("lang", "size", "print", step).distinct().groupBy("lang", "size", "step").agg(F.count(F.lit(1)).alias("n")))
    width = F.greatest(F.floor(fence * (F.col("q3") - F.col("q1"))), F.lit(int(least_width / STEP)))
    edge = [(F.col("q1") - width).alias("low"), (F.col("q3") + width).alias("high")]
    whole = _quartiles(hist, ["lang"]).where(F.col("m") >= min_texts).select("lang", *[e.alias(f"all_{n}") for e, n in zip(edge, ("low", "high"))])
    own = _quartiles(hist, ["lang", "size"]).select("lang", "size", *[F.when(F.col("m") >= min_texts, e).alias(n) for e, n in zip(edge, ("low", "high"))])
    both = join_null_safe(own, whole, ["lang"], "left")
    return both.select("lang", "size", F.coalesce("low", "all_low").alias("low"), F.coalesce("high", "all_high").alias("high"))


def judge(docs: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER,
          max_runs: int = MAX_RUNS, **band_options) -> DataFrame:
    """One row per document row: id, the base columns, ``base_failed``, ``score``, ``kept``."""
    names = {"text_col": text_col, "lang_col": lang_col, "order": order}
    model = fit(count_runs(docs, **names), order)
    scored = materialise(measure(docs, model, doc_id=doc_id, max_runs=max_runs, **names))
    free(model)
    limits = materialise(bands(scored, **band_options))
    out = join_null_safe(scored.withColumns({"base_failed": base_failed(), "size": length_class()}), limits, ["lang", "size"], "left")
    step = F.floor(F.col("score") / STEP)
    inside = F.coalesce((step >= F.col("low")) & (step <= F.col("high")), F.lit(True))
    return out.select(F.col("_id").alias(doc_id), *BASE, "base_failed", "score", (~F.col("base_failed") & inside).alias("kept"))
