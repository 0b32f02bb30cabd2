"""Corpus preparation: the stages a training corpus passes, in order.

``STAGES`` lists (name, function); each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written and reread as the next
stage's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.store import free, materialise
from tessera.llm import stages

STAGES = [
    ("toxicity", stages.toxicity),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("pii", stages.pseudonyms),
    ("mixing", stages.mixing_stage),
]

#: classifier, components and keyed permutations are beyond SQL; tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows go through a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs)
            free(before)
    return docs
