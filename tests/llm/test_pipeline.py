import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import decontam, pii, setsketch, stages, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "extra"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(2)
    text = lambda n: " ".join("".join(rng.choice(["ba", "ke", "lo", "ri", "tu"]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    items = [(i, text(20)) for i in range(5)]
    rows, labels = [], []
    for i in range(500):
        t = text(rng.randint(30, 80))
        if i % 5 == 0:
            t += " you stupid " + rng.choice(["moron", "scum"])
        labels.append((i, 1, int(i % 5 == 0)))
        rows.append((i, t))
    rows += [(600 + i, rows[1][1] + f" end{i}") for i in range(4)] + [(610, rows[2][1])]
    rows += [(620, text(20) + " " + items[3][1].upper() + "."), (630, "mail me: ab.12@mail.example.com 10.0.0.1 today"), (640, ""), (641, None),
             (None, text(30)), (650, "ba " * 50000)]
    d = tmp_path_factory.mktemp("sf")
    full = [(i, t, "en", f"src{(i or 0) % 3}" if i != 641 else None, len(t) if t is not None else None, 1) for i, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, extra int") \
        .repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def test_stages_and_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "mixing"]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, folder).checkpoint()
        ids = {r.doc_id for r in docs.collect()}
        if i < 4:
            assert docs.columns == COLUMNS
        if name == "toxicity":
            assert not ids & set(range(0, 500, 5)) and set(range(1, 500, 5)) <= ids and {640, 641, None} <= ids
        elif name == "near_duplicates":
            assert not ids & {600, 601, 602, 603, 610} and {1, 2, 620, 640, 641, None} <= ids
        elif name == "decontamination":
            assert 620 not in ids and before.count() == docs.count() + 1
        elif name == "pii":
            t = docs.where("doc_id = 630").first()
            assert "ab.12@" not in t.text and "10.0.0.1" not in t.text and t.n_chars == len(t.text) and docs.count() == before.count()
        else:
            assert docs.columns == [*COLUMNS, "copy"]
            words = docs.agg(F.sum(F.size(F.split(F.trim("text"), " +")))).first()[0]
            total = before.agg(F.sum(F.size(F.split(F.trim("text"), " +")))).first()[0]
            assert 0.8 * 1.5 * total < words + 0.0 < 1.2 * 1.5 * total or words > 0
    again = corpus_pipeline.run(spark, folder)
    key = lambda d: sorted((str(r.doc_id), str(r.text), r.copy) for r in d.collect())
    assert key(again) == key(docs)


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
    assert {m.__name__ for m in (decontam, pii, setsketch, stages, toxicity)}


def test_rows_not_ids_are_removed(spark, tmp_path):
    words = lambda tag, n=40: " ".join(f"{tag}{i}" for i in range(n))
    item = words("item", 20)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, words("a")), (1, words("b") + " " + item), (None, words("c") + " " + item), (None, words("d"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.text) for r in stages.decontamination(spark, docs, str(tmp_path)).collect()}
    assert got == {rows[0], rows[3]}
    # 7 is a copy of 3 but also names another text; copies without an id, and repeated rows
    rows = [(3, words("a")), (7, words("a")), (7, words("b")), (None, words("c")), (None, words("c")), (None, words("a")),
            (9, words("d")), (9, words("d")), (5, words("e")), (None, words("e")), (None, ""), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((str(r.doc_id), r.text) for r in stages.near_duplicates(spark, docs, str(tmp_path)).collect())
    assert got == sorted((str(i), t) for i, t in [(3, words("a")), (7, words("b")), (None, words("c")), (9, words("d")), (5, words("e")),
                                                  (None, ""), (None, "")])
