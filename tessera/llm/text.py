"""Vectorised tokenising and hashing of whole Arrow batches.

Texts of a batch are handled as one byte buffer, in chunks of whole documents
of about ``CHUNK`` bytes (a longer document is a chunk of its own), so memory
per task is bounded by the longest text, not by the batch.

Hashes are 64-bit polynomial fingerprints over a random byte table: with the
prefix sums S of ``table[byte] * P**i``, any byte range [a, b) has the value
``(S[b] - S[a]) * P**-a``, so ranges of any length cost O(1).
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
U = np.uint64

_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_P = int(_rng.integers(1 << 60, 1 << 62)) * 2 + 1
_PINV = pow(_P, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LOWER_TABLE = _TABLE[LOWER]

_bytes = np.arange(256)
#: words of letters and digits (after lower-casing) and of every non-ASCII character
ALNUM = ((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 65) & (_bytes <= 90)) | \
    ((_bytes >= 97) & (_bytes <= 122)) | (_bytes >= 128)
#: words that end at ASCII white space
NONSPACE = ~((_bytes == 32) | ((_bytes >= 9) & (_bytes <= 13)))
#: letters only (and every non-ASCII character)
LETTER = ALNUM & ~((_bytes >= 48) & (_bytes <= 57))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise a 64-bit value so that every bit depends on every other."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_P, _PINV):
        p = np.full(n, U(base))
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int):
    """P**i and P**-i for i < n (cached for sizes rounded up to a power of two)."""
    size = 1 << max(16, int(n - 1).bit_length() if n > 1 else 1)
    a, b = _powers(size)
    return a[:n], b[:n]


def buffers(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    binary = pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type)
    if arr.null_count:
        arr = pc.fill_null(arr, b"" if binary else "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    n, bufs = len(arr), arr.buffers()
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def chunks(arr, limit: int = CHUNK):
    """Yield (first row, end row, bytes, offsets) for runs of whole documents."""
    data, offs = buffers(arr)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


class Words:
    """Words of a chunk: byte ranges, first word of each document, word hashes."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, kind: np.ndarray):
        self.data, self.offs = data, offs
        n = len(data)
        if n == 0:
            self.starts = self.ends = np.zeros(0, np.int64)
        else:
            w = kind[data]
            before = np.empty(n, bool)
            before[0] = False
            before[1:] = w[:-1]
            before[offs[:-1][offs[:-1] < n]] = False
            after = np.empty(n, bool)
            after[-1] = False
            after[:-1] = w[1:]
            cut = offs[1:]
            after[cut[cut > 0] - 1] = False
            self.starts = np.flatnonzero(w & ~before)
            self.ends = np.flatnonzero(w & ~after) + 1
        #: words of document d are [first[d], first[d + 1])
        self.first = np.searchsorted(self.starts, offs)
        self._sums = None

    def sums(self):
        if self._sums is None:
            n = len(self.data)
            p, self._inv = powers(n + 1)
            s = np.zeros(n + 1, np.uint64)
            np.cumsum(_LOWER_TABLE[self.data] * p[:n], out=s[1:])
            self._sums = s
        return self._sums

    def range_hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Fingerprints of the lower-cased byte ranges [a, b)."""
        s = self.sums()
        return mix((s[b] - s[a]) * self._inv[a] + (b - a).astype(np.uint64))

    def hashes(self) -> np.ndarray:
        return self.range_hash(self.starts, self.ends)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def normalised(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, document offsets, word offsets): the lower-cased words, each followed by one space.

        Word offsets count from the start of their document's bytes; a document
        has one more than words, so word i takes [off[i], off[i + 1] - 1).
        """
        lens = self.ends - self.starts
        out_starts = np.zeros(len(lens) + 1, np.int64)
        np.cumsum(lens + 1, out=out_starts[1:])
        out = np.full(out_starts[-1], 32, np.uint8)
        if len(lens):
            src = np.arange(lens.sum(), dtype=np.int64)
            shift = np.repeat(self.starts - np.concatenate(([0], np.cumsum(lens)[:-1])), lens)
            dst = src + np.repeat(np.arange(len(lens)), lens)
            out[dst] = LOWER[self.data[src + shift]]
        return out, out_starts[self.first], out_starts


def ngram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Fingerprints of all runs of k consecutive hashes (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    m = 0x9E3779B97F4A7C15
    for j in range(k):
        out += h[j:j + n] * U(pow(m, 2 * j + 1, 1 << 64) | 1)
    return mix(out)


def tokens_batch(kind_name: str, column: str, keep: list[str], k: int = 1):
    """mapInArrow function: the kept columns plus, per text, its words.

    ``_n`` words, ``_tokens`` the hashes of its words (or of its runs of ``k``
    words, one from each word that has k - 1 behind it) and a last element ``SENTINEL``,
    ``_norm`` their lower-cased bytes (each with a space behind), ``_offs``
    the byte offset of each word in ``_norm`` and the end. The sentinel lets a
    join of the tokens with a small table keep one row for every document.
    """
    kind = {"alnum": ALNUM, "nonspace": NONSPACE}[kind_name]

    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in chunks(batch.column(column)):
                w = Words(data, offs, kind)
                h, n = w.hashes(), w.counts()
                norm, dofs, wofs = w.normalised()
                d = hi - lo
                ends = w.first[1:]
                tofs = np.concatenate(([0], np.cumsum(n + 1))).astype(np.int32)
                if k == 1:
                    toks, gofs = np.insert(h, ends, U(SENTINEL)).view(np.int64), tofs
                else:
                    g = ngram_hashes(h, k)                     # runs over the whole chunk
                    m = np.maximum(n - k + 1, 0)
                    own = np.arange(m.sum()) + np.repeat(w.first[:-1] - (np.cumsum(m) - m), m)
                    toks = np.insert(g[own], np.cumsum(m), U(SENTINEL)).view(np.int64)
                    gofs = np.concatenate(([0], np.cumsum(m + 1))).astype(np.int32)
                base = np.repeat(dofs[:-1], n + 1)
                idx = np.arange(tofs[-1]) - np.repeat(np.arange(d), n + 1)
                rel = (wofs[idx] - base).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(lo, d) for c in keep] + [
                        pa.array(n.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(gofs), pa.array(toks)),
                        pa.Array.from_buffers(pa.binary(), d, [None, pa.py_buffer(dofs.astype(np.int32)), pa.py_buffer(norm)]),
                        pa.ListArray.from_arrays(pa.array(tofs), pa.array(rel))],
                    names=[*keep, "_n", "_tokens", "_norm", "_offs"])
    return run


SENTINEL = 0x5EED_0F_7E557E5D
SENTINEL_LONG = SENTINEL if SENTINEL < 1 << 63 else SENTINEL - (1 << 64)
TOKEN_COLUMNS = "_n int, _tokens array<long>, _norm binary, _offs array<int>"


def hash_words(words: list[str]) -> list[int]:
    """Hashes of given lower-case words, equal to those of ``Words.hashes`` (as signed longs)."""
    raw = [w.encode() for w in words]
    offs = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    w = Words(np.frombuffer(b"".join(raw), np.uint8), offs, np.ones(256, bool))
    return w.range_hash(offs[:-1], offs[1:]).view(np.int64).tolist()
