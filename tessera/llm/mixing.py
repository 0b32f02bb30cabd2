"""Mixing sources to target weights by pivotal dependent rounding.

Targets: the mix's size (``share`` of all words) is dealt to the sources by
weight, no source above ``max_copies`` times its own words, the excess dealt
again by weight until none is above (water filling; one row per source).

Rounding: every document of a source starts with the same expected number of
copies, target / source size. Its fractional part is rounded in pairs: of two
open documents mass is moved from one to the other, at random but with
unchanged expectation and unchanged expected words (probabilities weighted by
the documents' sizes), until one of them is an integer; the other stays open
and meets the next, largest documents first. A group leaves at most one open
document. The last one of a source is decided by a coin; the words it then
takes too many or too few are given back by closed documents of its last group,
largest first, as far as they fit: a source misses its target by less than the
smallest document that could be turned there.

The groups form a reduction tree: documents are dealt by hash into groups of
about ``GROUP`` rows per source, each group is rounded in one task, and the
residuals (one row per group) are dealt into groups again until one is left
per source, which is rounded by a coin. A source of any size is thus spread
over many tasks, each holding a bounded group.

All coins are hashes of (seed, row, level), so reruns agree.

Defined results: null texts have size 0; documents of size 0 are taken once in
expectation like the others but weigh nothing, so they are not rounded and get
the floor of their expected copies; a null source is a source of its own, last;
repeated rows take part each for itself. No document is taken more than
``max_copies`` times.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import materialise, numbered, small, tidy

WEIGHTS = (3.0, 1.0, 2.0)
#: rows of a group that one call rounds
GROUP = 20_000
EPS = 1e-9


def size_column(text_col: str):
    """Words that end at ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, *, weights=WEIGHTS, share: float = 1.5, max_copies: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size); weights repeat over sources by code point, null last.

    Water filling by thresholds: with ratio = cap / weight ascending, a source
    is capped exactly if the level reached without it would exceed its ratio.
    """
    w = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))     # one row per source
    wt = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(w) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = sizes.withColumn("weight", wt)
    t = t.withColumn("cap", max_copies * F.col("source_size").cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    every = Window.partitionBy(F.lit(0))
    t = t.withColumn("total", share * F.sum("source_size").over(every).cast("double")).withColumn("all_w", F.sum("weight").over(every))
    up = Window.orderBy("ratio", F.col("source").isNull(), F.col("source").cast("binary"))
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    cap_before = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    w_before = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # the level if every source from here on were uncapped
    t = t.withColumn("level", (F.col("total") - cap_before) / (F.col("all_w") - w_before))
    t = t.withColumn("capped", F.col("level") >= F.col("ratio"))
    # beyond the first uncapped source the running level only falls
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(every)
    t = t.withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * level))
    return t.select("source", "source_size", "target")


def _coin(key: np.ndarray, seed: int) -> np.ndarray:
    from .text import mix
    return (mix(key.view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2 ** 64)) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def round_pairs(p: np.ndarray, size: np.ndarray, coin: np.ndarray):
    """Pivotal rounding along the sequence: (rounded values, index of the open entry or -1).

    Entries are probabilities in (0, 1); p @ size is kept up to the open entry.
    """
    out = p.copy()
    i = -1
    for j in range(len(p)):
        if out[j] <= EPS or out[j] >= 1 - EPS:
            out[j] = round(out[j])
            continue
        if i < 0:
            i = j
            continue
        si, sj = size[i], size[j]
        # largest steps that move words from j to i, and from i to j
        to_i = min((1 - out[i]) * si, out[j] * sj)
        to_j = min(out[i] * si, (1 - out[j]) * sj)
        move = to_i if coin[j] < to_j / (to_i + to_j) else -to_j
        out[i] += move / si
        out[j] -= move / sj
        closed_i = out[i] <= EPS or out[i] >= 1 - EPS
        closed_j = out[j] <= EPS or out[j] >= 1 - EPS
        if closed_i:
            out[i] = round(out[i])
        if closed_j:
            out[j] = round(out[j])
        i = j if closed_i and not closed_j else (-1 if closed_i else i)
    return out, i


def give_back(p: np.ndarray, size: np.ndarray, words: float, but: int) -> None:
    """Turn closed entries, largest first, until the missing ``words`` (negative: too many) are taken, as far as they fit."""
    to = 1.0 if words > 0 else 0.0
    left = abs(words)
    for i in np.lexsort((np.arange(len(p)), -size)).tolist():
        if i != but and p[i] == 1 - to and size[i] <= left + EPS:
            p[i] = to
            left -= size[i]


def _round_group(seed: int, last: bool):
    def run(pdf):
        # documents of like size meet, so that large ones close each other
        pdf = pdf.sort_values(["size", "h", "row"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        coin = _coin(pdf["h"].to_numpy(np.int64), seed)
        size = pdf["size"].to_numpy(float)
        p, rest = round_pairs(pdf["p"].to_numpy(float), size, coin)
        if last and rest >= 0:
            whole = float(_coin(pdf["h"].to_numpy(np.int64)[rest:rest + 1], seed + 1)[0] < p[rest])
            give_back(p, size, (p[rest] - whole) * size[rest], rest)
            p[rest], rest = whole, -1
        pdf["p"] = p
        pdf["open"] = False
        if rest >= 0:
            pdf.loc[rest, "open"] = True
        return pdf[["src", "row", "h", "size", "p", "open"]]
    return run


_ROUND = "src long, row long, h long, size long, p double, open boolean"


def dependent_rounding(rows: DataFrame, seed: int = 11, group: int = GROUP) -> DataFrame:
    """(src, row, h, size, p) with 0 < p < 1, size > 0 -> the same rows with p 0 or 1."""
    many = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max(group // 10, 1)).select("h", F.lit(True).alias("hot"))
    rows = materialise(rows.join(small(materialise(many)), "h", "left")
                       .withColumn("spread", F.when(F.col("hot"), F.col("row")).otherwise(F.lit(0).cast("long"))).drop("hot"))
    done, level = None, 0
    biggest = rows.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    biggest = biggest.agg(F.max("n")).first()[0] or 0
    while True:
        groups = -(-biggest // group) or 1
        last = groups == 1
        # rows of one hash (repeated rows, null ids of one size) are dealt by place where they would fill a group
        cell = F.pmod(F.xxhash64("h", "spread", F.lit(seed + level)), F.lit(groups))
        out = rows.withColumn("cell", cell).groupBy("src", "cell").applyInPandas(_round_group(seed + 7 * level, last), _ROUND)
        out = materialise(out)
        closed = out.where(~F.col("open"))
        done = closed if done is None else done.unionByName(closed)
        if last:
            return done.select("src", "row", "h", "p")
        rows = out.where("open").select("src", "row", "h", "size", "p", F.lit(0).cast("long").alias("spread"))
        biggest, level = groups, level + 1


def copies(docs: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text", source_col: str = "source",
           row: str | None = None, weights=WEIGHTS, share: float = 1.5, max_copies: float = 2.0, seed: int = 11,
           group: int = GROUP) -> DataFrame:
    """One row per document row: ``row``, ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``.

    ``row`` names a column of unique longs; without it rows are numbered here.
    """
    base = materialise(docs.select(
        (F.col(row) if row else F.monotonically_increasing_id()).alias("row"), F.col(f"`{doc_id}`").alias("_id"),
        F.col(f"`{source_col}`").alias("source"), size_column(text_col).alias("size")))
    per = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = materialise(targets(per, weights=weights, share=share, max_copies=max_copies)
                    .withColumn("src", F.xxhash64(F.col("source").isNull(), F.col("source"))))
    c = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    j = base.join(t, base["source"].eqNullSafe(t["source"])).select(
        "row", "_id", base["source"], "size", "source_size", "target", "src", c.alias("c"))
    # a hash of the document, not of its place, so that the order of the input does not matter
    j = j.withColumn("h", F.xxhash64(F.lit(seed), F.col("_id"), F.col("size")))
    whole = F.floor(F.col("c") + EPS)
    j = j.withColumn("whole", whole).withColumn("p", F.greatest(F.col("c") - F.col("whole"), F.lit(0.0)))
    open_ = j.where((F.col("p") > EPS) & (F.col("size") > 0)).select("src", "row", "h", "size", "p")
    r = dependent_rounding(open_, seed, group).select("row", F.col("p").alias("extra"))
    out = j.join(r, "row", "left")
    return out.select("row", F.col("_id").alias(doc_id), "source", "size", "source_size", "target",
                      (F.col("whole") + F.coalesce("extra", F.lit(0.0))).cast("long").alias("copies"))


def mix(docs: DataFrame, copy_col: str = "copy", **options) -> DataFrame:
    """The documents as often as the mix takes them, with all their columns; ``copy_col`` counts from 1."""
    names = docs.columns
    rows = numbered(docs)
    n = materialise(copies(rows, row="_row", **options).where("copies > 0").select(F.col("row").alias("_row"), F.col("copies").alias("_copies")))
    tidy(docs.sparkSession)
    out = rows.join(small(n), "_row").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return out.select(*[F.col(f"`{c}`") for c in names], F.col("_copy").alias(copy_col))
