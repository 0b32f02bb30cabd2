"""Token counts by a linear longest-match automaton.

The greedy (longest-match-first) segmentation of every word is only counted,
never built. The vocabulary's byte trie gets failure links and, with each, the
number of tokens popped on the way (the longest pieces that cover what is read
so far), as in the linear WordPiece algorithm of Song et al. (2021). Resolving
the links ahead for every (state, byte) gives a complete automaton: one table
look-up per byte yields the next state and the tokens popped, whatever the
input, so the time is linear in the text.

Words are the runs between ASCII white space; ``prefix`` (the vocabulary's
word mark) is put before each. Bytes that start no piece count one token each
(byte fallback), so every text has a count. The vocabulary is read from a path
given by the caller (its size bounds the automaton).

Within a task equal words are counted once per chunk; the automaton walks all
distinct words of a chunk in lockstep, one vectorised step per byte position.

Defined results: null and empty texts have 0 words and 0 tokens; repeated rows
are counted each; no text is cut.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import NONSPACE, U, Words, chunks, mix, powers, _TABLE

MARK = "▁"


def read_vocabulary(path: str) -> list[bytes]:
    """Pieces of a sentencepiece model (byte fallback and control pieces left out: bytes are always pieces)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i).encode() for i in range(sp.get_piece_size())
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]


class Automaton:
    """Complete automaton over bytes: ``step[state, byte]``, ``pops[state, byte]``, ``rest[state]`` (tokens popped at the end)."""

    def __init__(self, pieces):
        children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in sorted({bytes([b]) for b in range(256)} | set(pieces) - {b""}):
            u = 0
            for c in piece:
                v = children[u].get(c)
                if v is None:
                    v = children[u][c] = len(children)
                    children.append({})
                    final.append(False)
                u = v
            final[u] = True
        n = len(children)
        step = np.zeros((n, 256), np.int32)
        pops = np.zeros((n, 256), np.uint8)
        rest = np.zeros(n, np.int32)
        # fail[v], popped[v]: where the walk goes on once v's string can't be extended, tokens cut off by that
        fail, popped = [0] * n, [0] * n
        for c, v in children[0].items():
            step[0, c] = v
        queue = [(v, 0, c) for c, v in children[0].items()]
        for v, u, c in queue:                       # breadth first: shorter strings are complete
            if final[v]:
                fail[v], popped[v] = 0, 1
            else:
                # go on with c from u's fallback: the table of shorter states already resolves it
                f = fail[u]
                fail[v], popped[v] = int(step[f, c]), popped[u] + int(pops[f, c])
            f = fail[v]
            step[v] = step[f]
            pops[v] = pops[f] + popped[v]
            rest[v] = popped[v] + rest[f]
            for b, w in children[v].items():
                step[v, b], pops[v, b] = w, 0
                queue.append((w, v, b))
        self.step, self.pops, self.rest = step.ravel(), pops.ravel(), rest

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefix: bytes = b"") -> np.ndarray:
        """Tokens of each byte range, read after ``prefix``."""
        state0, cost0 = 0, 0
        for c in prefix:
            cost0 += int(self.pops[state0 * 256 + c])
            state0 = int(self.step[state0 * 256 + c])
        lens = ends - starts
        order = np.argsort(-lens, kind="stable")
        lens, at = lens[order], starts[order]
        state = np.full(len(order), state0, np.int64)
        cost = np.full(len(order), cost0, np.int64)
        longest = int(lens[0]) if len(lens) else 0
        # active[j]: words longer than j
        active = np.searchsorted(-lens, -np.arange(1, longest + 1), "right")
        for j in range(longest):
            m = active[j]
            k = state[:m] * 256 + data[at[:m] + j]
            cost[:m] += self.pops[k]
            state[:m] = self.step[k]
        out = np.empty(len(order), np.int64)
        out[order] = cost + self.rest[state]
        return out


@functools.lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    """Built once per worker process."""
    return Automaton(read_vocabulary(path))


def _hash_case(w: Words) -> np.ndarray:
    """Word fingerprints that tell cases apart."""
    p, inv = powers(len(w.data) + 1)
    s = np.zeros(len(w.data) + 1, np.uint64)
    np.cumsum(_TABLE[w.data] * p[:len(w.data)], out=s[1:])
    return mix((s[w.ends] - s[w.starts]) * inv[w.starts] + (w.ends - w.starts).astype(U))


def _count_batch(path: str, prefix: str):
    import pyarrow as pa

    def run(batches):
        auto = automaton(path)
        for batch in batches:
            for lo, hi, data, offs in chunks(batch.column("_text")):
                w = Words(data, offs, NONSPACE)
                tokens = np.zeros(hi - lo, np.int64)
                if len(w.starts):
                    _, first, back = np.unique(_hash_case(w), return_index=True, return_inverse=True)
                    cost = auto.counts(data, w.starts[first], w.ends[first], prefix.encode())[back]
                    total = np.concatenate(([0], np.cumsum(cost)))
                    tokens = total[w.first[1:]] - total[w.first[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(lo, hi - lo), pa.array(w.counts().astype(np.int64)), pa.array(tokens)],
                    names=["_id", "n_words", "n_tokens"])
    return run


def token_counts(docs: DataFrame, vocabulary: str, *, doc_id: str = "doc_id", text_col: str = "text",
                 prefix: str = MARK) -> DataFrame:
    """One row per document row: ``n_words``, ``n_tokens``. One scan, no shuffle."""
    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    return src.mapInArrow(_count_batch(vocabulary, prefix), "_id long, n_words long, n_tokens long") \
        .withColumnRenamed("_id", doc_id)
