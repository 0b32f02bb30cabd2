import random
import zlib

import numpy as np
import pytest

from tessera.llm import toxicity as tox

BAD = ["stupid", "moron", "scum", "pathetic", "crétin"]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    syl = ["ta", "ri", "no", "be", "lo", "mi", "su", "ke", "da", "pe", "é"]
    text = lambda n: [("".join(rng.choice(syl) for _ in range(rng.randint(1, 4)))) for _ in range(n)]
    rows = []
    for i in range(1600):
        w, bad = text(rng.randint(5, 60)), i % 6 == 0
        if bad:
            for x in rng.sample(BAD, 2):
                w.insert(rng.randint(0, len(w)), rng.choice([x, x.upper() + "!!", x]))
        rows.append((i, " ".join(w), int(bad)))
    return rows


def test_decode_and_score(spark, docs_of, corpus):
    docs = docs_of([r[:2] for r in corpus] + [(9000, None), (9001, ""), (9002, "tari " * 300000), (None, "tari nobe"), (0, corpus[0][1])])
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in corpus] + [(5000, 1, 1), (3, None, None), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    model = tox.fit(docs, labels)
    for raw, want in [("stup1d", "stupid"), ("m0r0n", "moron"), ("s c u m", "scum"), ("p-a-t-h-e-t-i-c", "pathetic"),
                      ("stuuupid", "stupid"), ("$cum", "scum"), ("m.o.r.o.n", "moron"), ("tari", "tari"), ("crét1n", "crétin")]:
        assert tox.decode(raw, model["lm"]) == want, raw
    got = {r.doc_id: r for r in tox.predict(docs, labels).collect()}
    assert len(got) == 1604
    held = [(got[i].predicted, y) for i, _, y in corpus if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in corpus)
    assert np.mean([p == y for p, y in held]) > 0.98
    assert got[9000].predicted == 0 and got[9000].score == got[9001].score and 0 <= got[9002].score < 0.3
    new = [(1, "no be ta stup1d lo mi"), (2, "ta ri s.t.u.p.i.d m o r o n no"), (3, "no be lo"), (4, "STUUUPID and m0r0n talo")]
    s = {r.doc_id: r.score for r in tox.score(docs_of(new), model, keep=["doc_id"]).collect()}
    assert s[1] >= 0.3 and s[2] >= 0.3 and s[4] >= 0.3 and s[3] < 0.3


def test_no_training_rows(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.score < 1e-6 for r in tox.predict(docs_of([(1, "a b"), (2, None)]), labels).collect())
    assert tox.predict(docs_of([]), labels).count() == 0


def test_disguised_ranges():
    t = "plain words!! he11o a b c d. x y é l'un www sooo (ok) 2024 $x a1"
    data = np.frombuffer(t.encode(), np.uint8)
    s, e = tox.disguised(data, np.array([0, len(data)]))
    assert [data[a:b].tobytes().decode() for a, b in zip(s, e)] == ["he11o", "a b c d. x y é", "l'un", "www", "sooo", "$x"]


def test_language_model_counts_everything(spark, docs_of):
    d = docs_of([(1, "ab ab"), (2, "AB"), (3, None), (4, "")])
    n = {r.gram: r.n for r in tox.trigrams(d).collect()}
    code = lambda a, b, c: (a * tox.CLASSES + b) * tox.CLASSES + c
    assert n[code(0, 1, 2)] == 3 and n[code(1, 2, 0)] == 3


def test_every_disguise_reaches_the_lattice(spark, docs_of, corpus):
    t = "a$$ @$$ kil1 !diot (lown |ow +oad st€al stuupid plain"
    data = np.frombuffer(t.encode(), np.uint8)
    s, e = tox.disguised(data, np.array([0, len(data)]), every=True)
    assert [data[a:b].tobytes().decode() for a, b in zip(s, e)] == t.split()[:-1]
    data = np.frombuffer(b"an id iot longer is", np.uint8)
    s, e = tox.pieces(data, np.array([0, len(data)]))
    assert sorted(data[a:b].tobytes().decode() for a, b in zip(s, e)) == ["an id", "an id iot", "id iot"]
    docs = docs_of([r[:2] for r in corpus])
    model = tox.fit(docs, spark.createDataFrame([(i, 1, y) for i, _, y in corpus], "doc_id long, quality int, toxic int"))
    new = ["no be ta stuupid lo mi", "ta ri no sc um lo mi be", "lo be moro|\\| ta cr€tin", "no be lo m0ronn", "ta crét!n lo", "tari nobe lo ta be ri"]
    got = {r.doc_id: r.score for r in tox.score(docs_of(list(enumerate(new))), model, keep=["doc_id"]).collect()}
    assert got[0] >= tox.THRESHOLD and got[1] >= tox.THRESHOLD and got[4] >= tox.THRESHOLD and got[5] < tox.THRESHOLD, got
