import random

import numpy as np
import pytest

from tessera.llm import mtree, wordpieces
from tessera.llm.text import CHUNK


def greedy(word: bytes, pieces) -> int:
    n = i = 0
    longest = max(map(len, pieces), default=1)
    while i < len(word):
        m = next((m for m in range(min(longest, len(word) - i), 1, -1) if word[i:i + m] in pieces), 1)
        i, n = i + m, n + 1
    return n


@pytest.mark.parametrize("seed", range(6))
def test_automaton_against_greedy(seed):
    rng = random.Random(seed)
    alpha = b"abc"
    pieces = {bytes(rng.choice(alpha) for _ in range(rng.randint(1, 6))) for _ in range(rng.choice([0, 3, 12, 40]))}
    auto = wordpieces.Automaton(pieces)
    words = [bytes(rng.choice(alpha + b"z") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    data = np.frombuffer(b"".join(words) + b"!", np.uint8)
    ends = np.cumsum([len(w) for w in words])
    got = auto.counts(data, ends - [len(w) for w in words], ends, b"ab")
    assert got.tolist() == [greedy(b"ab" + w, pieces) for w in words]


def test_token_counts(spark, docs_of):
    path = "/opt/tokenizers/piece_bpe_32k.model"
    pieces = set(wordpieces.read_vocabulary(path))
    rows = [(1, "Hello world, héllo wörld  \n x"), (2, None), (3, ""), (4, "日本語 \U0001f600 abcabc"), (5, "the " * (CHUNK // 2)),
            (1, "Hello world, héllo wörld  \n x"), (None, "x" * 5000)]
    got = {(r.doc_id, r.n_words, r.n_tokens) for r in wordpieces.token_counts(docs_of(rows), path).collect()}
    want = set()
    for d, t in rows:
        w = (t or "").split()
        one = {x: greedy((wordpieces.MARK + x).encode(), pieces) for x in set(w)}
        want.add((d, len(w), sum(one[x] for x in w)))
    assert got == want
    assert wordpieces.token_counts(docs_of([]), path).count() == 0


def brute(rows, every, k):
    ok = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % every == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(b) == len(a))[:k]
            out += [(q, r + 1, i, -n) for r, (n, i) in enumerate(s)]
    return sorted(set(out))


@pytest.mark.parametrize("kind", ["clusters", "ties", "few"])
def test_top_k_against_brute_force(spark, kind):
    rng = np.random.default_rng(4)
    n = {"clusters": 700, "ties": 400, "few": 5}[kind]
    if kind == "ties":
        x = rng.integers(-1, 2, (n, 3)) / 4
    else:
        x = rng.normal(size=(8, 6))[rng.integers(0, 8, n)] + rng.normal(size=(n, 6)) * 0.1
    rows = [(i, [float(np.float32(e)) for e in v]) for i, v in enumerate(x)]
    rows += [(1000, None), (1010, [1.0, None, 2.0]), (1020, [float("nan")] * 6), (1030, [float("inf")] * 6), (None, rows[0][1]), (1040, [])]
    d = spark.createDataFrame([(i, v, 3) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = mtree.search(d, every=10, k=10, shard_rows=200, query_block=16).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows, 10, 10)


def test_top_k_empty(spark):
    assert mtree.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_tree_skips_distances():
    rng = np.random.default_rng(2)
    v = (rng.normal(size=(20, 8))[rng.integers(0, 20, 4000)] * 500 + rng.normal(size=(4000, 8)) * 10).astype(np.int64)
    norm = (v * v).sum(1)
    extra = np.sqrt((norm.max() - norm).astype(float))
    tree = mtree.Tree(np.arange(4000), v, extra, mtree.build(np.concatenate([v.astype(float), extra[:, None]], 1)))
    best, computed = tree.search(v[7], 7, 10, float(norm[7] + norm.max()))
    want = sorted(((-int(v[i] @ v[7]), i) for i in range(4000) if i != 7))[:10]
    assert [(-s, i) for s, i in best] == want and computed < 2000
