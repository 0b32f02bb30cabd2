"""Set combination, sampling, splitting and folds.

Randomness is a pure function of ``(seed, key)``: the order
``md5(seed ':' key)``. Results are exact (exact counts, exact quotas),
repeatable on any partitioning or after executor loss, and the same order
can be written in SQL. Ranks come from ``order.hash_rank`` -- no global
sort, no single partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .order import hash_head, hash_hex, hash_rank


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


# ------------------------------------------------------------- union/split
def union_tagged(frames: dict, tag: str = "split") -> DataFrame:
    """Union by column name (missing columns -> NULL) with an origin tag."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def split_by_tag(df: DataFrame, tag: str = "split", drop_tag: bool = True) -> dict:
    """The inverse of ``union_tagged`` (one lazy filter per tag value;
    the tag values are a tiny distinct set)."""
    names = [r[0] for r in df.select(tag).distinct().collect()]
    out = {}
    for n in names:
        part = df.where(F.col(tag) == F.lit(n))
        out[n] = part.drop(tag) if drop_tag else part
    return out


def join_on_key(frames: list, key, how: str = "inner") -> DataFrame:
    """Side-by-side combination on an explicit key (the only join shape
    the reference needs; positional alignment does not exist in Spark)."""
    key = _as_list(key)
    return reduce(lambda a, b: a.join(b, on=key, how=how), frames)


def align(df: DataFrame, sampled_keys: DataFrame, key: str) -> DataFrame:
    """U4: keep rows whose key was sampled (left semi join)."""
    return df.join(sampled_keys.select(key), on=key, how="left_semi")


# ------------------------------------------------------------- sampling
def sample_n(df: DataFrame, n: int, seed, key: str) -> DataFrame:
    """M1: exactly ``min(n, rows)`` rows without replacement; the first ``n``
    in md5 order."""
    return hash_head(df, key, seed, F.lit(int(n)), out="_r").where("_r").drop("_r")


def bootstrap_n(df: DataFrame, n: int, seed, key: str, out: str = "draw") -> DataFrame:
    """M2: ``n`` draws with replacement. Draw ``i`` picks dense row index
    ``md5(seed ':' i) mod N``; the draw table (n rows, generated by
    ``spark.range`` in parallel) is equi-joined to the dense index, so a row
    drawn k times appears k times (with ``draw`` = draw number)."""
    spark = df.sparkSession
    indexed = hash_rank(df, key, seed, out="_idx")  # 1..N, also _n_stratum
    total = indexed.agg(F.count(F.lit(1)).alias("_N"))
    draws = spark.range(n).withColumnRenamed("id", out)
    pick = F.conv(F.substring(hash_hex(F.col(out), f"{seed}b"), 1, 15), 16, 10).cast("decimal(20,0)")
    draws = draws.crossJoin(F.broadcast(total)).withColumn(
        "_idx", (F.pmod(pick, F.col("_N")) + 1).cast("long")).drop("_N")
    return indexed.join(draws, on="_idx", how="inner").drop("_idx", "_n_stratum")


# ------------------------------------------------------------- splits
def _quota_size(n, size):
    """Rows in the test part: fraction -> ceil(size * n); int -> size."""
    if isinstance(size, float) and size < 1:
        return F.ceil(F.lit(size) * n)
    return F.least(F.lit(int(size)), n)


def train_test_split(df: DataFrame, test_size, seed, key: str, stratify: str | None = None,
                     tag: str = "split") -> DataFrame:
    """M3/M4: tag every row 'train' or 'test' with exact sizes.

    Unstratified: the first ``n_test`` rows in md5 order are test.
    Stratified: each class gets ``floor(n_c * n_test / N)`` test rows, the
    remaining ``n_test - sum(floor)`` go one each to the classes with the
    largest remainders (ties: class order) -- shares kept exactly like a
    stratified splitter, positions repeatable."""
    if stratify is None:
        r = hash_head(df, key, seed, _quota_size(F.col("_n_stratum"), test_size), out="_r")
    else:
        r = hash_head(df, key, seed, lambda cnt: _quotas(cnt, stratify, test_size), strata=[stratify], out="_r")
    return r.withColumn(tag, F.when(F.col("_r"), "test").otherwise("train")).drop("_r")


def class_quotas(df: DataFrame, label: str, size) -> DataFrame:
    """(label, _quota) test rows per class by largest remainder. One row per
    class (a class column is low-cardinality by definition)."""
    return _quotas(df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc")), label, size)


def _quotas(cnt: DataFrame, label: str, size) -> DataFrame:
    tot = Window.partitionBy()
    n = F.sum("_nc").over(tot)
    t = _quota_size(n, size)
    c = cnt.withColumn("_t", t).withColumn("_exact", F.col("_nc").cast("double") * F.col("_t") / n)
    c = c.withColumn("_fl", F.floor("_exact")).withColumn("_rem", F.col("_exact") - F.col("_fl"))
    left = F.col("_t") - F.sum("_fl").over(tot)
    order = Window.partitionBy().orderBy(F.col("_rem").desc(), F.col(label))
    c = c.withColumn("_extra", (F.row_number().over(order) <= left).cast("long"))
    return c.select(label, (F.col("_fl") + F.col("_extra")).cast("long").alias("_quota"))


def nested_split(df: DataFrame, first_size, second_size, seed, key: str, stratify: str | None = None,
                 tag: str = "split") -> DataFrame:
    """M5: stratified split twice. Stage 1 keeps ``first_size`` rows as the
    working set (the rest is 'holdout'); stage 2 takes ``second_size`` of the
    working set as 'train' and the remainder as 'valid'."""
    # stage 1 feeds three branches (working set, holdout, stage-2 quotas):
    # materialise it once instead of re-ranking the source per branch
    s1 = cut_lineage(train_test_split(df, first_size, seed, key, stratify, tag="_s1"))
    work = s1.where(F.col("_s1") == "test").drop("_s1")
    hold = s1.where(F.col("_s1") == "train").drop("_s1").withColumn(tag, F.lit("holdout"))
    s2 = train_test_split(work, second_size, f"{seed}/2", key, stratify, tag="_s2")
    s2 = s2.withColumn(tag, F.when(F.col("_s2") == "test", "train").otherwise("valid")).drop("_s2")
    return s2.unionByName(hold)


def assign_folds(df: DataFrame, k: int, key: str, mode: str = "stratified", seed=0,
                 label: str | None = None, out: str = "fold") -> DataFrame:
    """M6: ``fold`` in 0..k-1.

    * ``contiguous`` -- unshuffled KFold: rows in key order, first
      ``N % k`` folds one row larger.
    * ``shuffled``   -- same sizes, md5 order instead of key order.
    * ``stratified`` -- per class, fold = (rank - 1) mod k in md5 order, so
      every fold gets the class in equal shares (+-1).
    """
    if mode == "stratified":
        if label is None:
            raise ValueError("stratified folds need a label")
        r = hash_rank(df, key, seed, strata=[label], out="_r")
        return r.withColumn(out, ((F.col("_r") - 1) % k).cast("int")).drop("_r", "_n_stratum")
    if mode == "shuffled":
        r = hash_rank(df, key, seed, out="_r")
    elif mode == "contiguous":
        from .order import global_position
        r = global_position(df, key, out="_r").withColumn("_r", F.col("_r") + 1)
        r = r.crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias("_n_stratum"))))
    else:
        raise ValueError(mode)
    n = F.col("_n_stratum")
    base = F.floor(n / k)
    big = n % k  # folds 0..big-1 have base+1 rows
    pos = F.col("_r") - 1
    fold = F.when(pos < big * (base + 1), F.floor(pos / (base + 1))) \
        .otherwise(big + F.floor((pos - big * (base + 1)) / base))
    return r.withColumn(out, fold.cast("int")).drop("_r", "_n_stratum")


__all__ = ["union_tagged", "split_by_tag", "join_on_key", "align", "sample_n", "bootstrap_n",
           "train_test_split", "class_quotas", "nested_split", "assign_folds"]
