import hashlib
import random

import numpy as np
import pytest

from tessera.llm import components, repeats, setsketch
from tessera.llm.text import CHUNK


def shingles(t, k):
    import re
    w = [x for x in re.split(rb"[\x20\x09-\x0D]+", (t or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))) if x]
    m = min(k, len(w))
    return frozenset(tuple(w[i:i + m]) for i in range(len(w) - m + 1)) if m else frozenset()


def brute(rows, k, num, den):
    sets = {d: shingles(t, k) for d, t in rows}
    par = {d: d for d in sets}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            n = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * n >= num * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(a), find(b)
                par[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def near_rows(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for g in range(n // 6):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(1, 80))]
        for _ in range(6):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = f"e{rng.randint(0, 99)}"
            rows.append((len(rows), rng.choice([" ", "\n", " \t"]).join(w)))
    return rows


@pytest.mark.parametrize("seed,k,num", [(0, 3, 85), (1, 5, 80), (2, 3, 85)])
def test_near_duplicates_against_brute_force(spark, docs_of, seed, k, num):
    rows = near_rows(seed) + [(500, ""), (501, None), (502, "One two"), (503, "one  TWO"), (504, "   "), (505, "z " * (CHUNK // 2))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setsketch.near_duplicates(docs_of(rows), k=k, num=num, den=100).collect()}
    assert got == brute(rows, k, num, 100)


def test_large_group_with_chain(spark, docs_of, monkeypatch):
    # a chain of small changes: far ends of a group are not similar, but linked
    monkeypatch.setattr(setsketch, "BLOCK", 16)
    w = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(70):
        rows.append((i, " ".join(w)))
        w[(i * 7) % 60] = f"c{i}"
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setsketch.near_duplicates(docs_of(rows), k=3, num=85, den=100).collect()}
    assert got == brute(rows, 3, 85, 100)


def test_repeated_and_null_ids(spark, docs_of):
    rows = [(1, "a b c d e f"), (1, "q r s t u v"), (2, "q r s t u v"), (None, "a b c d e f"), (None, None)]
    got = setsketch.near_duplicates(docs_of(rows), k=5).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [
        ("1", "1", True), ("1", "1", True), ("2", "1", False), ("None", "None", True), ("None", "None", True)]
    assert setsketch.near_duplicates(docs_of([])).count() == 0


def test_registers():
    rng = np.random.default_rng(0)
    e, share = [], []
    for _ in range(40):
        a = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
        x, y = a[:2000], a[200:2200]
        r1, r2 = setsketch.registers(x), setsketch.registers(y)
        assert (setsketch.registers(np.union1d(x, y)) == setsketch.merge(r1, r2)).all()
        e.append(setsketch.estimate(r1[None], r2[None], [2000], [2000])[0])
        share.append((r1 == r2).mean())
    true = 1800 / 2200
    assert abs(np.mean(e) - true) < 0.02 and np.mean(share) > true - 0.02
    assert np.std(e) < 0.06


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)] + [(5, 5), (None, 3)]
    par = {}

    def find(x):
        while par.setdefault(x, x) != x:
            x = par[x]
        return x
    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            par[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in par}


# --- repeated strings -------------------------------------------------------

def brute_repeats(rows, width):
    seen, out = {}, []
    raw = [(d, (t or "").encode()) for d, t in rows]
    for _, b in raw:
        for i in range(len(b) - width + 1):
            s = b[i:i + width]
            seen[s] = seen.get(s, 0) + 1
    for d, b in raw:
        cover = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                cover[i:i + width] = b"\1" * width
        n = sum(1 for i, c in enumerate(cover) if c and (i == 0 or not cover[i - 1]))
        rest = bytes(c for c, g in zip(b, cover) if not g)
        out.append((str(d), len(b), sum(cover), n, hashlib.sha256(rest).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_repeats_against_brute_force(spark, docs_of, seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdeé \n") for _ in range(n))
    parts = [text(n) for n in (150, 300, 300, 420, 700)]
    rows = []
    for i in range(30):
        t = "".join(rng.choice([text(rng.randint(0, 300)), p, p[rng.randint(0, 40):], p[:rng.randint(100, 700)]])
                    for p in rng.choices(parts, k=3))
        rows.append((i, t))
    rows += [(100, None), (101, ""), (102, "ab" * 700), (103, "x" * 260), (104, "x" * 261 + "y"), (None, parts[3]), (7, rows[7][1]), (105, "z" * 30000)]
    got = repeats.remove_repeats(docs_of(rows), width=256).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(rows, 256)
    for r in got:
        assert sum(b - a for a, b in zip(r.starts, r.ends)) == r.n_removed and len(r.kept) == r.n_bytes - r.n_removed


def test_planted_passages_of_over_50_words(spark, docs_of, tmp_path):
    from tessera.llm.queries import QUERIES
    rng = random.Random(5)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    long, short = words(60), words(55)      # 419 and 384 bytes
    rows = [(i, f"{words(40)} {p} {words(40)}") for i, p in enumerate([long] * 3 + [short] * 3 + [words(60) for _ in range(3)])]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op5_suffix_array_dedup"](spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(rows, 400)
    # the width is in bytes: a shared passage below it stays, whatever its words
    assert [r.n_removed >= 419 for r in sorted(got)] == [True] * 3 + [False] * 6
    assert [r.n_removed for r in sorted(got)][3:] == [0] * 6


def test_repeats_empty_table(spark, docs_of):
    assert repeats.remove_repeats(docs_of([])).count() == 0
    with pytest.raises(ValueError):
        repeats.remove_repeats(docs_of([]), width=100)


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_texts_that_share_a_doc_id_lose_no_link(spark, docs_of, parts):
    """Rows of one id are one document: it joins what any of its texts is near to, and is told by the smallest id."""
    words = lambda tag, n=60: " ".join(f"{tag}{i}" for i in range(n))
    a, b = words("a"), words("b")
    rows = [(5, a), (5, b), (7, b + " more"), (9, a + " more"), (5, words("c")), (11, words("d")), (3, words("c") + " more"), (20, words("e")), (20, "")]
    got = sorted({(r.doc_id, r.component_id) for r in setsketch.near_duplicates(docs_of(rows, parts), k=3, num=85, den=100).collect()})
    assert got == [(3, 3), (5, 3), (7, 3), (9, 3), (11, 11), (20, 20)]
