import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import lookup, resampling
from tessera.llm.text import mix


def test_crc_from_states():
    rng = random.Random(1)
    a = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 5, 63, 64, 65, 300, 5000]))) for _ in range(200)]
    b = a[::-1]
    data = np.frombuffer(b"".join(a) + b"-", np.uint8)
    ends = np.cumsum([len(x) for x in a])
    got = resampling.crcs(data, ends - [len(x) for x in a], ends)
    assert got.tolist() == [zlib.crc32(x) for x in a]
    assert resampling.and_space(got).tolist() == [zlib.crc32(x + b" ") for x in a]
    both = resampling.shift(resampling.and_space(got), np.array([len(x) for x in b])) ^ got[::-1]
    assert both.tolist() == [zlib.crc32(x + b" " + y) for x, y in zip(a, b)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1000, 70000])
def test_sorted_hashes(n):
    h = mix(np.arange(1, n + 1, dtype=np.uint64))
    s = lookup.SortedHashes(h)
    at = s.find(np.concatenate([h, mix(np.arange(n + 1, n + 500, dtype=np.uint64))]))
    assert (s.h[at[:n]] == h).all() and (at[n:] == -1).all()


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, items):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s = Counter(bucket(f) for _, t in docs for f in features(t)[1])
    t = Counter(bucket(f) for x in items for f in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(float(t[b] + 1) * float(S + 10000) / (float(s[b] + 1) * float(T + 10000))))
    out = []
    for place, (i, x) in enumerate(docs):
        n, fs = features(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in fs)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n, place])
    order = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[6]))
    for k, r in enumerate(order[:5 * len(order) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


WORDS = ["the", "a", "of", "Über", "data42", "spark", "日本語", "x" * 80, "É", "é"]


@pytest.mark.parametrize("head", [(0, 0), (6, 8), (1 << 16, 1 << 17)])
def test_against_brute_force(spark, docs_of, head):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(WORDS) + rng.choice(["", ",", "\n", str(rng.randint(0, 30))]) for _ in range(rng.randint(0, 60))))
            for i in range(150)]
    rows += [(900, None), (901, ""), (902, "!!"), (903, "one"), (904, "y" * 200000 + " end"), (905, "Word " * 30000), (None, "the of " * 15)]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, "the of " * 15)]
    items = ["the a of data42 spark", None, "", "Über " * 9, "data42 spark " * 40]
    bench = spark.createDataFrame([(i, x, 3) for i, x in enumerate(items)], "item_id long, text string, n_words int")
    got = resampling.resample(docs_of(rows), bench, head_words=head[0], head_pairs=head[1])
    got = [(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()]
    want = brute(rows, items)
    assert sorted((x[:4] for x in got), key=str) == sorted((x[:4] for x in want), key=str)
    assert sorted(x[1:] for x in got if x[4]) == sorted(x[1:] for x in want if x[4])       # equal rows tie by place
    assert sum(x[4] is not None for x in got) == 5 * sum(features(t)[0] >= 20 for _, t in rows) // 100


def test_ties_and_empty(spark, docs_of):
    same = docs_of([(1, "w " * 25)] * 40 + [(2, "w " * 25)] * 60)
    bench = spark.createDataFrame([], "item_id long, text string")
    got = resampling.resample(same, bench).collect()
    ranks = [r for r in got if r["rank"]]
    top = max(r.score for r in got)
    assert sorted(r["rank"] for r in ranks) == [1, 2, 3, 4, 5] and all(r.score == top for r in ranks)
    assert resampling.resample(docs_of([]), bench).count() == 0
