import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import decontam, licenses
from tessera.llm.text import CHUNK

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def brute(docs, items, width=10):
    win = {}
    for i, t in items:
        w = words(t)
        m = min(width, len(w))
        for a in range(len(w) - m + 1 if m else 0):
            win.setdefault(tuple(w[a:a + m]), set()).add(str(i))
    sizes = {len(k) for k in win}
    out = []
    for d, t in docs:
        w, hit, its = words(t), set(), set()
        for m in sizes:
            for a in range(len(w) - m + 1):
                if tuple(w[a:a + m]) in win:
                    hit |= set(range(a, a + m))
                    its |= win[tuple(w[a:a + m])]
        out.append((d, len(w), len(hit), len(its), ",".join(sorted(its)), bool(hit)))
    return sorted(out, key=str)


def corpus(seed=0):
    rng = random.Random(seed)
    vocab = ["a", "b", "der", "été", "x1", "Foo", "bar-baz", "qu", "zz"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([0, 3, 9, 10, 14, 25]))) for i in range(12)] + [(12, None), (13, ""), (14, "a b")]
    docs = []
    for i in range(60):
        t = text(rng.randint(0, 60))
        if i % 3 == 0:
            t += "!" + (rng.choice(items)[1] or "").upper() + ", " + text(5)
        docs.append((i, t))
    return docs + [(90, None), (91, ""), (92, "?!"), (5, docs[5][1]), (None, docs[3][1]), (93, text(90000))], items


@pytest.mark.parametrize("limit", [decontam.BROADCAST_BYTES, 0])
def test_decontamination_against_brute_force(spark, docs_of, limit):
    docs, items = corpus()
    it = spark.createDataFrame(items, "item_id long, text string")
    src = docs_of(docs).checkpoint()
    got = decontam.decontaminate(src, it, broadcast_bytes=limit)
    got = sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in got.collect()], key=str)
    assert got == brute(docs, items)


def test_decontamination_empty_tables(spark, docs_of):
    it = spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminate(docs_of([]), it).count() == 0
    r = decontam.decontaminate(docs_of([(1, "a b c")]), it).collect()
    assert [(x.n_words, x.contaminated) for x in r] == [(3, False)]


def test_proximity(spark, docs_of):
    it = spark.createDataFrame([(1, "the rare1 gap gap rare2 the")], "item_id long, text string")
    d = docs_of([(1, "the rare1 the the rare2"), (2, "rare1 " + "the " * 30 + "rare2"), (3, "gap gap gap the the")])
    got = decontam.proximity_matches(d, it, slop=5).collect()
    assert [(r.doc_id, r.item_id, r.distance) for r in got] == [(1, "1", 3)]


def brute_license(t):
    w = words(t)
    places = [(a, lab) for lab, p in licenses.BASE for a in range(len(w)) if w[a:a + len(p.split())] == p.split()]
    return (len(w), len(places), min([a for a, _ in places], default=None), max([a for a, _ in places], default=None),
            ",".join(sorted({x for _, x in places})))


def test_license_scan(spark, docs_of):
    rng = random.Random(1)
    parts = ["MIT License", "mit", "license", "Apache-License", "general PUBLIC license", "public", "text", "the", "über"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "mit license"), (103, "x " * CHUNK + "mit license"), (1, rows[1][1]), (None, "mit license"),
             (104, "Permission is hereby granted, free of charge, to anyone obtaining a copy of this software and its "
                   "associated documentation files, to deal in the Software without restriction"),
             (105, "Licensed under CC BY-NC 4.0."), (106, "mit"), (107, "free text of charge in the license")]
    got = licenses.scan(docs_of(rows).checkpoint()).collect()
    key = lambda x: str(x)
    assert sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got], key=key) == \
        sorted([(d, *brute_license(t)) for d, t in rows], key=key)
    by = {r.doc_id: r for r in got}
    assert by[104].labels == "mit" and by[104].n_base == 0
    assert by[105].labels == "cc-by-nc" and by[105].score == 1.0
    assert by[106].labels == "" and by[107].labels == "" and by[101].score == 0.0
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got)
    assert licenses.scan(docs_of([])).count() == 0


def test_clashing_column(spark, docs_of):
    d = docs_of([(1, "a b c")])
    assert licenses.scan(d.withColumn("label", F.lit(1))).first().n_words == 3
