import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing


def water(sizes, weights=(3.0, 1.0, 2.0), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out = share * sum(sizes.values()), {}
    free = set(names)
    while free:
        level = (total - sum(out.values())) / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level >= cap * sizes[s]}
        if not over:
            out.update({s: w[s] * level for s in free})
            break
        out.update({s: cap * sizes[s] for s in over})
        free -= over
    return out


def test_round_pairs_keeps_words_and_expectation():
    rng = np.random.default_rng(0)
    p, size = rng.uniform(0.05, 0.95, 40), rng.integers(1, 50, 40).astype(float)
    total = np.zeros(40)
    for s in range(3000):
        out, rest = mixing.round_pairs(p, size, np.random.default_rng(s).random(40))
        closed = np.ones(40, bool)
        if rest >= 0:
            closed[rest] = False
        assert np.all(np.isin(out[closed], (0.0, 1.0)))
        assert abs(out @ size - p @ size) < 1e-6
        total += out
    assert np.abs(total / 3000 - p).max() < 0.06


@pytest.mark.parametrize("group", [7, 20_000])
def test_mix(spark, docs_of, group):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        n = int(rng.integers(0, 40))
        src = ["big", "big", "big", "a", "é", None][int(rng.integers(0, 6))]
        rows.append((i, " w\t" * n if n else ("" if i % 2 else None), src))
    rows += [rows[5], (900, "one two", "tiny"), (None, "x y z", "a"), (901, "z " * 60000, "huge")]
    d = docs_of(rows)
    got = mixing.copies(d, group=group).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = water(sizes)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
    biggest = {}
    for r in got:
        biggest[r.source] = max(biggest.get(r.source, 0), r.size)
    for s, t in taken.items():
        assert abs(t - want[s]) <= biggest[s], s
    again = mixing.copies(d.repartition(5), group=group).collect()
    key = lambda r: (str(r.doc_id), r.size, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mix_empty(spark, docs_of):
    assert mixing.copies(docs_of([])).count() == 0
    r = mixing.copies(docs_of([(1, None), (2, "")])).collect()
    assert [x.copies for x in r] == [0, 0] and [x.target for x in r] == [0.0, 0.0]


def test_sizes(spark):
    d = spark.createDataFrame([("a b c d  e\n\f",), ("",), (None,)], "text string")
    assert [r[0] for r in d.select(mixing.size_column("text")).collect()] == [3, 0, 0]
    assert d.select(F.lit(1)).count() == 3


@pytest.mark.parametrize("sizes", [[100] * 9, [5, 100, 1000, 30, 2, 700, 10], [0, 0, 4], [7], [1, 10**6, 1, 1, 5]])
def test_targets(spark, sizes):
    rows = [(None if i == 2 else f"s{i:02d}", n) for i, n in enumerate(sizes)]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "source string, source_size long")).collect()}
    want = water(dict(rows))
    for s in want:
        assert got[s] == pytest.approx(want[s])


def test_few_documents_of_very_different_sizes(spark, docs_of):
    """A source's large documents no longer decide how near it comes to its target."""
    rng = np.random.default_rng(9)
    rows = [(1000 * s + i, "w " * int(n), f"s{s:02d}") for s in range(6) for i, n in enumerate(np.exp(rng.normal(5, 1.6, 50)).clip(1, 6000))]
    got = mixing.copies(docs_of(rows)).collect()
    taken, target = {}, {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] for s in taken)


@pytest.mark.parametrize("one_id", [True, False])
def test_repeated_rows_spread_over_groups(spark, docs_of, one_id, monkeypatch):
    sizes, run = [], mixing._round_group

    def watched(seed, last):
        inner = run(seed, last)
        return lambda pdf: inner(pdf).assign(p=float(len(pdf))) if len(pdf) > 400 else inner(pdf)
    monkeypatch.setattr(mixing, "_round_group", watched)
    rows = [(1 if one_id else None, "a b c d", "s")] * 2000 + [(i, "e f " * (i % 5 + 1), "t") for i in range(100)]
    got = mixing.copies(docs_of(rows), group=100).collect()
    assert len(got) == 2100 and max(r.copies for r in got) <= 2              # a group of 400 rows would have returned its size
    taken = sum(r.copies * r.size for r in got if r.source == "s")
    want = next(r.target for r in got if r.source == "s")
    assert abs(taken - want) <= 4 and not sizes
