"""Stages of ``corpus_pipeline.py``: (spark, docs, sf_dir) -> docs with the same columns (the last one adds ``copy``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import decontam, mixing, pii, setsketch, toxicity as tox
from .queries import PII_KEY
from .store import materialise, numbered, small, tidy


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose number is not in ``gone``. Stages decide by row, as ids may be null or shared."""
    gone = materialise(gone.select("_row"))
    tidy(rows.sparkSession)                                      # what the decision shuffled is spent
    return rows.join(small(gone), "_row", "left_anti").drop("_row")


def toxicity(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = tox.fit(docs, labels)
    scored = tox.score(docs, model, keep=docs.columns, name="_score")
    return scored.where(F.col("_score") < tox.THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: the smallest doc_id (null ids last), of its rows the first (5-word shingles, similarity 0.8 or more).

    Texts without words are in no group; all their rows stay.
    """
    rows = numbered(docs)
    d = setsketch.near_duplicates(rows, doc_id="_row", k=5, num=80, den=100).select("_row", "component_id")
    d = materialise(d.join(rows.select("_row", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row").alias("at")), "_row"))
    first = d.groupBy("component_id").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = d.join(first, "component_id").where(F.col("_row") != F.col("first._row"))
    return _without(rows, gone).select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a 10-word window of a benchmark item (a whole item, if shorter) go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = numbered(docs)
    d = decontam.decontaminate(rows, items, width=10, row="_row")
    return _without(rows, d.where("contaminated")).select(*[F.col(f"`{c}`") for c in docs.columns])


def pseudonyms(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms; ``n_chars`` follows where a date's length changes."""
    old = F.length("text")
    out = pii.pseudonymise(docs.withColumn("_old", old), PII_KEY, count_col=None)
    out = out.withColumn("n_chars", (F.col("n_chars") + F.length("text") - F.col("_old")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; ``copy`` counts from 1."""
    return mixing.mix(docs)
