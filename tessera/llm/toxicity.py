"""Toxicity scoring of deobfuscated text.

1. **Character language model.** Trigram counts over the bytes of all
   documents (59 classes: a-z, 32 classes of non-ASCII bytes, one for anything
   else), summed per task and then by Spark: at most 59**3 sums reach the driver.
2. **Noisy channel.** Tokens that hold a sign of ``LEET`` anywhere or a doubled
   letter, runs of single letters, and two or three neighbouring tokens of at
   most three characters joined (pieces of a word) become character lattices: a sign may stand for a letter
   (leetspeak), be a separator that is dropped, or be itself; a repeated letter
   may be dropped. Viterbi finds the most probable plain text under the
   channel's costs and the language model. Decoding is linear in the token.
3. **Score.** Words of the text and of the restored tokens, and their prefixes
   of 4 to 7 bytes, are features. A feature's counts are the distinct contexts
   (neighbouring words) it has in toxic and in other training documents, so
   copies of one document count once; features whose precision has a lower
   Wilson bound (z = 3.5) of half the decision threshold or more are kept, with
   the log ratio of their densities in toxic and other text as evidence. A
   document sums the evidence of its distinct words; a logistic fit of that sum
   and the text's length on the training rows with evidence gives the
   probability, their share of toxic rows that of texts without evidence.

Training reads at most ``max_rows`` labelled rows (smallest hash of the id
first), that bound alone makes the label table fit a broadcast. Ids, source,
language and labels are no inputs of a score.

Defined results: null and empty texts get the score of any text without
evidence; repeated rows are scored each; labels repeated for an id
count once (the larger); with no training rows every score is about 0. Whole
texts are read.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialise
from .text import ALNUM, LETTER, LOWER, NONSPACE, U, Words, chunks, mix

#: training rows read at most
MAX_ROWS = 20_000
Z = 3.5
THRESHOLD = 0.3
PREFIXES = (4, 5, 6, 7)
CLASSES = 59

_b = np.arange(256)
_CLASS = np.where((_b >= 97) & (_b <= 122), _b - 96, np.where(_b >= 128, 27 + (_b & 31), 0)).astype(np.int64)

#: letters a sign may stand for
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y"}
#: signs that may stand for a first letter (others are punctuation there)
_SIGN = np.isin(_b, [ord(c) for c in "0123456789@$"])
#: the signs of one byte, and the bytes of the longer ones
_ANY_SIGN = np.isin(_b, [ord(c) for c in LEET if ord(c) < 128])
_LONG_SIGNS = [np.frombuffer(c.encode(), np.uint8) for c in LEET if ord(c) >= 128]
#: tokens of so many characters at most may be pieces of a word, up to so many of them
PIECE, PIECES = 3, 3
#: log costs of the channel
SUBSTITUTE, SEPARATE, LITERAL, REPEAT_LONG, REPEAT_TWO = -1.0, -1.0, -4.0, -0.3, -3.0


def lower(data: np.ndarray) -> np.ndarray:
    """Lower-case ASCII and the Latin-1 letters of UTF-8 (byte 0xC3)."""
    out = LOWER[data]
    if len(out) > 1:
        up = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
        out[1:][up] += 32
    return out


# --- language model ---------------------------------------------------------

def _gram_batch(batches):
    import pyarrow as pa
    total = np.zeros(CLASSES ** 3, np.int64)
    for batch in batches:
        for _, _, data, offs in chunks(batch.column("_text")):
            if not len(data):
                continue
            c = _CLASS[lower(data)]
            c = np.insert(c, offs[:-1], 0)                       # texts start at a boundary
            c = np.append(c[(c != 0) | (np.concatenate(([1], c[:-1])) != 0)], 0)
            if len(c) >= 3:
                total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES ** 3)
    g = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(total[g])], names=["gram", "n"])


def trigrams(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(gram, n): character trigram counts of the whole corpus."""
    src = docs.select(F.col(f"`{text_col}`").alias("_text"))
    return src.mapInArrow(_gram_batch, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(counts: DataFrame) -> np.ndarray:
    """log P(c | a, b) as a 59 x 59 x 59 array, trigrams interpolated with bigrams and letters."""
    n = np.zeros(CLASSES ** 3)
    for r in counts.collect():                       # at most 59**3 rows
        n[r["gram"]] = r["n"]
    n = n.reshape((CLASSES,) * 3)
    two, one = n.sum(0), n.sum((0, 1))
    p1 = (one + 1) / (one.sum() + CLASSES)
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    return np.log((n + 5 * p2[None]) / (n.sum(2, keepdims=True) + 5))


# --- noisy channel ----------------------------------------------------------

def _code(ch: str) -> list[int]:
    return [int(_CLASS[x]) for x in ch.encode()]


def decode(token: str, lm: np.ndarray) -> str:
    """Most probable plain text of a lower-case token; words are separated by one space."""
    n = len(token)
    # states: (class before last, last class) -> (log probability, text); a text starts at a boundary
    states = {(0, 0): (0.0, "")}

    def extend(to, state, value, text, out, cost):
        a, b = state
        for c in _code(out) if out != " " else [0]:
            if c == 0 and b == 0:
                continue                             # boundaries run together
            cost += lm[a, b, c]
            a, b = b, c
        score = value + cost
        if score > to.get((a, b), (-np.inf,))[0]:
            to[(a, b)] = (score, text + out)

    for i, ch in enumerate(token):
        to: dict = {}
        letter = ch.isalpha()
        same = i > 0 and token[i - 1] == ch
        run = same and ((i > 1 and token[i - 2] == ch) or (i + 1 < n and token[i + 1] == ch))
        for state, (value, text) in states.items():
            if letter:
                extend(to, state, value, text, ch, 0.0)
            else:
                extend(to, state, value, text, " ", LITERAL)
                for sub in LEET.get(ch, ""):
                    extend(to, state, value, text, sub, SUBSTITUTE)
                if not ch.isalnum():
                    extend(to, state, value, text, "", SEPARATE)
            if same:
                extend(to, state, value, text, "", REPEAT_LONG if run else REPEAT_TWO)
        states = to
    best = max(((v + lm[a, b, 0] * (b != 0), t) for (a, b), (v, t) in states.items()), default=(0.0, ""))
    return " ".join(best[1].split())


def disguised(data: np.ndarray, offs: np.ndarray, every: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of tokens (or runs of single letters) that may be disguised words, in order.

    With ``every``, all tokens that hold a sign of ``LEET`` anywhere or a doubled letter; without it, likely ones.
    """
    w = Words(data, offs, NONSPACE)
    if not len(w.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = lower(data)
    letter = LETTER[low]
    seen = np.concatenate(([0], np.cumsum(letter)))
    odd = np.flatnonzero(NONSPACE[low] & ~letter)
    tok = np.searchsorted(w.starts, odd, "right") - 1
    before = seen[odd] - seen[w.starts[tok]] > 0
    after = seen[w.ends[tok]] - seen[odd] > 0
    flag = np.zeros(len(w.starts), bool)
    flag[tok[after & (before | _SIGN[low[odd]])]] = True
    if len(low) > 2:
        three = np.flatnonzero((low[:-2] == low[1:-1]) & (low[1:-1] == low[2:]) & letter[:-2] & (low[:-2] < 128))
        flag[np.searchsorted(w.starts, three, "right") - 1] = True
    if every and len(low) > 1:
        hits = [np.flatnonzero(_ANY_SIGN[low]), np.flatnonzero((low[:-1] == low[1:]) & letter[:-1] & (low[:-1] < 128))]
        for sign in _LONG_SIGNS:
            n = len(low) - len(sign) + 1
            if n > 0:
                hits.append(np.flatnonzero(np.logical_and.reduce([low[k:n + k] == x for k, x in enumerate(sign)])))
        flag[np.searchsorted(w.starts, np.concatenate(hits), "right") - 1] = True
    # runs of three or more one-letter tokens (signs beside the letter do not matter)
    chars = np.concatenate(([0], np.cumsum(ALNUM[low] & ((low & 0xC0) != 0x80))))
    single = (chars[w.ends] - chars[w.starts] == 1)
    doc = np.searchsorted(offs, w.starts, "right")
    link = single[1:] & single[:-1] & (doc[1:] == doc[:-1])
    edge = np.flatnonzero(np.diff(np.concatenate(([0], link.astype(np.int8), [0]))))
    a, b = edge[0::2], edge[1::2]
    long_ = b - a >= 2
    a, b = a[long_], b[long_]
    inside = np.zeros(len(flag) + 1, np.int32)
    np.add.at(inside, a, 1)
    np.add.at(inside, b + 1, -1)
    alone = np.flatnonzero(flag & (np.cumsum(inside[:-1]) == 0))
    s = np.concatenate((w.starts[alone], w.starts[a]))
    e = np.concatenate((w.ends[alone], w.ends[b]))
    order = np.argsort(s, kind="stable")
    return s[order], e[order]


def pieces(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of two to ``PIECES`` neighbouring short tokens of a document, which may be one word in pieces."""
    w = Words(data, offs, NONSPACE)
    if len(w.starts) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    short = chars[w.ends] - chars[w.starts] <= PIECE
    doc = np.searchsorted(offs, w.starts, "right")
    link = short[1:] & short[:-1] & (doc[1:] == doc[:-1])
    s, e, run = [], [], link
    for n in range(2, PIECES + 1):
        at = np.flatnonzero(run)
        s.append(w.starts[at])
        e.append(w.ends[at + n - 1])
        run = run[:-1] & link[n - 1:]
    return np.concatenate(s), np.concatenate(e)


class Restorer:
    """Decodes disguised tokens, each distinct one once per task (least recently used ones are forgotten)."""

    def __init__(self, lm: np.ndarray):
        self.get = functools.lru_cache(maxsize=100_000)(lambda t: decode(t, lm))

    def join(self, raw: bytes) -> str:
        """The word that pieces make."""
        t = b"".join(raw.split()).decode("utf-8", "replace")
        # without signs and doubled letters nothing is to be decoded
        return t if t.isalpha() and all(a != b for a, b in zip(t, t[1:])) else self.get(t)


def features(data: np.ndarray, offs: np.ndarray, restore: Restorer):
    """(feature, context, document, word) arrays of a chunk: words, their prefixes, and those of restored tokens."""
    low = lower(data)
    s, e = disguised(low, offs, every=True)
    alone = len(s)
    ps, pe = pieces(low, offs)
    s, e = np.concatenate((s, ps)), np.concatenate((e, pe))
    doc = np.searchsorted(offs, s, "right") - 1
    raw = low.tobytes()
    out = [_word_features(low, offs)]
    got, ends, owner, where = [], [], [], []
    size = 0
    joined: dict = {}                                 # of the chunk
    for i, (a, b, d) in enumerate(zip(s.tolist(), e.tolist(), doc.tolist())):
        token = raw[a:b]
        if i < alone:
            text = restore.get(token.decode("utf-8", "replace")).encode()
        else:
            text = joined.get(token)
            if text is None:
                text = joined[token] = restore.join(token).encode()
        got.append(text)
        size += len(text)
        ends.append(size)
        owner.append(d)
    if got:
        buf = np.frombuffer(b"".join(got), np.uint8)
        f, c, d, word = _word_features(buf, np.concatenate(([0], np.array(ends, np.int64))))
        # the context of a restored word is what surrounds its token
        near = Words(low, np.array([0, len(low)]), NONSPACE)
        left = near.range_hash(np.maximum(s - 24, 0), s)
        out.append((f, left[d], np.array(owner, np.int64)[d], word))
    return tuple(np.concatenate(x) for x in zip(*out))


def _word_features(low, offs):
    w = Words(low, offs, LETTER)
    h = w.hashes()
    doc = np.repeat(np.arange(len(offs) - 1), w.counts())
    ctx = np.zeros(len(h), np.uint64)
    if len(h):
        same = doc[1:] == doc[:-1]
        ctx[1:] += np.where(same, h[:-1], U(0)) * U(3)
        ctx[:-1] += np.where(same, h[1:], U(0)) * U(5)
    out = [(h, ctx, doc, h)]
    n = w.ends - w.starts
    for k in PREFIXES:
        i = np.flatnonzero(n > k)
        out.append((w.range_hash(w.starts[i], w.starts[i] + k), ctx[i], doc[i], h[i]))
    return tuple(np.concatenate(x) for x in zip(*out))


# --- training and scoring ---------------------------------------------------

def _train_batch(lm, only):
    import pyarrow as pa
    known = None if only is None else np.sort(only)

    def run(batches):
        restore = Restorer(lm)
        for batch in batches:
            label = batch.column("toxic").to_numpy()
            for lo, hi, data, offs in chunks(batch.column("_text")):
                f, c, d, _ = features(data, offs, restore)
                y = label[lo:hi][d]
                use = y == 1 if known is None else ((y == 0) & np.isin(f, known))
                f, c = f[use], c[use]
                pairs = np.unique(np.stack([f, c], 1), axis=0) if len(f) else np.zeros((0, 2), np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, 0]).view(np.int64)),
                                                  pa.array(np.ascontiguousarray(pairs[:, 1]).view(np.int64))], names=["f", "c"])
    return run


def wilson(hits: np.ndarray, n: np.ndarray, z: float = Z) -> np.ndarray:
    """Lower bound of a proportion."""
    p = hits / n
    return (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def training_rows(labels: DataFrame, doc_id: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` (id, toxic) rows whose id is not held out."""
    i = F.col(doc_id)
    fit = labels.where(i.isNotNull() & F.col("toxic").isin(0, 1) & (F.crc32(i.cast("string")) % 4 != 2))
    fit = fit.groupBy(i.cast("long").alias("_id")).agg(F.max("toxic").alias("toxic"))
    return fit.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text",
        max_rows: int = MAX_ROWS) -> dict:
    """Language model, features with their evidence (at most a few per training word), and the calibration."""
    lm = language_model(trigrams(docs, text_col))
    rows = F.broadcast(training_rows(labels, doc_id, max_rows))          # max_rows rows of two numbers
    train = docs.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text")).join(rows, "_id")
    train = materialise(train.select("_text", "toxic"))
    count = lambda d: d.groupBy("f").agg(F.count_distinct("c").alias("n"))
    # a feature seen in fewer contexts could not reach the bound even if it were always toxic
    need = next(n for n in range(1, 1000) if wilson(np.array([float(n)]), np.array([float(n)]))[0] >= THRESHOLD / 2)
    pos = count(train.mapInArrow(_train_batch(lm, None), "f long, c long")).where(F.col("n") >= need).toPandas()
    keys = pos["f"].to_numpy(np.int64).view(np.uint64)
    neg = count(train.mapInArrow(_train_batch(lm, keys), "f long, c long")).toPandas()
    pos = pos.merge(neg, on="f", how="left", suffixes=("", "0")).fillna({"n0": 0})
    hits, miss = pos["n"].to_numpy(float), pos["n0"].to_numpy(float)
    keep = wilson(hits, np.maximum(hits + miss, 1)) >= THRESHOLD / 2
    f, hits, miss = pos["f"].to_numpy(np.int64).view(np.uint64)[keep], hits[keep], miss[keep]
    size = train.groupBy("toxic").agg(F.sum(F.length("_text")).alias("n")).collect()
    size = {r["toxic"]: float(r["n"] or 0) for r in size}
    # evidence of one occurrence: how much denser the feature stands in toxic than in other text
    w = np.log((hits + 0.5) / max(size.get(1, 0), 1)) - np.log((miss + 0.5) / max(size.get(0, 0), 1))
    order = np.argsort(f)
    model = {"lm": lm.astype(np.float32), "f": f[order], "w": np.maximum(w[order], 0.0), "fit": None}
    rows = train.mapInArrow(_score_batch(model, ["toxic"]), "toxic int, sum double, size double").toPandas()
    total, size, y = (rows[c].to_numpy(float) for c in ("sum", "size", "toxic"))
    some = total > 0
    model["fit"] = logistic(_inputs(total[some], size[some]), y[some])
    # without evidence: the smoothed share of toxic training rows without, at most the overall share
    model["none"] = min((y[~some].sum() + 0.1) / ((~some).sum() + 1.0), y.mean()) if len(y) else 0.0
    return model


def _inputs(total: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Inputs of the calibration; long texts hold more evidence by chance."""
    return np.stack([total, np.sqrt(total), np.log1p(size)], 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Coefficients of a small logistic model (last one: intercept), by damped Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    b = np.zeros(x.shape[1])
    if not len(x):
        b[-1] = -50.0
        return b
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (y - p) - ridge * b
        h = (x * (p * (1 - p))[:, None]).T @ x + (ridge + 1e-6) * np.eye(len(b))
        step = np.linalg.solve(h, g)
        b = b + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return b


def _score_batch(model: dict, keep: list[str]):
    """Kept columns and the score; before calibration the evidence (``sum``) and the text's ``size``."""
    import pyarrow as pa

    def run(batches):
        restore = Restorer(model["lm"])
        f, w, b = model["f"], model["w"], model["fit"]
        sieve = np.zeros(1 << 16, bool)
        sieve[(f & U(0xFFFF)).astype(np.int64)] = True
        for batch in batches:
            for lo, hi, data, offs in chunks(batch.column("_text")):
                total = np.zeros(hi - lo)
                if len(data) and len(f):
                    g, _, d, word = features(data, offs, restore)
                    may = np.flatnonzero(sieve[(g & U(0xFFFF)).astype(np.int64)])
                    at = np.minimum(np.searchsorted(f, g[may]), len(f) - 1)
                    hit = f[at] == g[may]
                    at, may = at[hit], may[hit]
                    # each distinct word of a document counts once, with its strongest feature
                    order = np.lexsort((-w[at], word[may], d[may]))
                    at, dd, ww = at[order], d[may][order], word[may][order]
                    first = np.ones(len(at), bool)
                    first[1:] = (dd[1:] != dd[:-1]) | (ww[1:] != ww[:-1])
                    np.add.at(total, dd[first], w[at[first]])
                size = np.diff(offs).astype(float)
                if b is None:
                    extra = [pa.array(total), pa.array(size)]
                else:
                    z = _inputs(total, size) @ b[:-1] + b[-1]
                    extra = [pa.array(np.where(total > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), model["none"]))]
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(lo, hi - lo) for c in keep] + extra,
                                                 names=[*keep, *(["sum", "size"] if b is None else ["score"])])
    return run


def score(docs: DataFrame, model: dict, *, text_col: str = "text", keep: list[str], name: str = "score") -> DataFrame:
    """The kept columns and the score as ``name``. One scan, no shuffle."""
    kinds = {x.name: x.dataType.simpleString() for x in docs.schema.fields}
    inner = [f"_c{i}" for i in range(len(keep))]                 # any column names are possible
    src = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, inner)], F.col(f"`{text_col}`").alias("_text"))
    ddl = ", ".join(f"{n} {kinds[c]}" for n, c in zip(inner, keep))
    return src.mapInArrow(_score_batch(model, inner), f"{ddl}, score double").toDF(*keep, name)


def predict(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text",
            max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per document row: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    model = fit(docs, labels, doc_id=doc_id, text_col=text_col, max_rows=max_rows)
    s = score(docs, model, text_col=text_col, keep=[doc_id])
    held = F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
    return s.select(doc_id, held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
