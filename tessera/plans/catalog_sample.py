"""Catalogue part 2: record repair, union/split, sampling, splits, folds
(S2, U, M). Every split is a pure function of md5(seed ':' key)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling
from ..sources.io import repair_records
from .frames import hdigit, hdigit_sql, long_scores, table
from .registry import query

SEED = 42


def _rank_sql(src: str, key: str, seed, part: str | None = None) -> str:
    p = f"PARTITION BY {part} " if part else ""
    return (f"row_number() OVER ({p}ORDER BY md5('{seed}:' || CAST({key} AS VARCHAR)), {key})")


def _quota_sql(src: str, label: str, size_expr: str) -> str:
    """(label, quota) by largest remainder, as in sampling.class_quotas."""
    return f"""(SELECT {label}, fl + CASE WHEN row_number() OVER (ORDER BY ex - fl DESC, {label})
                                   <= tt - sum(fl) OVER () THEN 1 ELSE 0 END AS quota
     FROM (SELECT *, nc * tt / n AS ex, floor(nc * tt / n) AS fl
           FROM (SELECT {label}, nc, sum(nc) OVER () AS n, {size_expr.replace('N', 'sum(nc) OVER ()')} AS tt
                 FROM (SELECT {label}, count(*) AS nc FROM {src} GROUP BY {label}))))"""


# ------------------------------------------------------------------ S2
@query("repair_glued_records", """
SELECT doc_id AS id, quality, toxic, CASE WHEN toxic = 1 THEN 'Presence' ELSE 'Absence' END AS label FROM labels""")
def repair_glued_records(spark, d):
    lab = table(spark, d, "labels")
    word = F.when(F.col("toxic") == 1, "Presence").otherwise("Absence")
    rec = F.concat_ws(",", F.col("doc_id").cast("string"), F.col("quality").cast("string"),
                      F.col("toxic").cast("string"), word)
    # records of 8 consecutive ids glued into one line (the line break after the label is lost)
    lines = lab.groupBy(F.floor(F.col("doc_id") / 8).alias("_blk")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", rec.alias("r")))).alias("_a")) \
        .select(F.array_join(F.transform("_a", lambda x: x["r"]), "").alias("value"))
    return repair_records(lines, "id BIGINT, quality INT, toxic INT, label STRING")


# ------------------------------------------------------------------ U
_SPLIT_O = hdigit_sql("o_orderkey", "split")


@query("union_split_tagged", f"""
SELECT CASE WHEN {_SPLIT_O} < '4' THEN 'train' ELSE 'test' END AS split, count(*) AS n,
       count(*) FILTER (WHERE {_SPLIT_O} >= '4') AS n_null_target
FROM orders GROUP BY 1""")
def union_split_tagged(spark, d):
    o = table(spark, d, "orders")
    is_train = hdigit("o_orderkey", "split") < "4"
    u = sampling.union_tagged({"train": o.where(is_train), "test": o.where(~is_train).drop("o_orderstatus")})
    parts = sampling.split_by_tag(u, drop_tag=False)
    back = parts["train"].unionByName(parts["test"])
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                     F.count_if(F.col("o_orderstatus").isNull()).alias("n_null_target"))


@query("join_predictions_on_key", """
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
                  CASE WHEN round(o_totalprice / 500000.0, 3) >= 0.5 THEN 1 ELSE 0 END AS pred_price FROM orders)
SELECT s.o_orderkey, s.label, s.pred_price, c.c_mktsegment
FROM s JOIN orders o ON s.o_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_predictions_on_key(spark, d):
    ls = long_scores(spark, d).where(F.col("model") == "s_price") \
        .select("o_orderkey", "label", F.col("prediction").alias("pred_price"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return sampling.join_on_key([ls, o], "o_orderkey").join(c, on="o_custkey").drop("o_custkey")


@query("align_sampled_lineitem", f"""
WITH s AS (SELECT o_orderkey FROM orders QUALIFY {_rank_sql('orders', 'o_orderkey', SEED)} <= 1000)
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM s)""")
def align_sampled_lineitem(spark, d):
    keys = sampling.sample_n(table(spark, d, "orders"), 1000, SEED, "o_orderkey").select(
        F.col("o_orderkey").alias("l_orderkey"))
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return sampling.align(li, keys, "l_orderkey")


# ------------------------------------------------------------------ M
@query("sample_n_orders", f"""
SELECT o_orderkey, o_totalprice FROM orders QUALIFY {_rank_sql('orders', 'o_orderkey', SEED)} <= 1000""")
def sample_n_orders(spark, d):
    return sampling.sample_n(table(spark, d, "orders"), 1000, SEED, "o_orderkey").select("o_orderkey", "o_totalprice")


@query("bootstrap_customers", f"""
WITH r AS (SELECT c_custkey, {_rank_sql('customer', 'c_custkey', SEED)} AS idx FROM customer),
p AS (SELECT range AS draw,
             CAST((('0x' || substr(md5('{SEED}b:' || CAST(range AS VARCHAR)), 1, 15))::UBIGINT
                   % (SELECT count(*) FROM customer)) + 1 AS BIGINT) AS idx FROM range(2000))
SELECT p.draw, r.c_custkey FROM p JOIN r ON p.idx = r.idx""")
def bootstrap_customers(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    return sampling.bootstrap_n(c, 2000, SEED, "c_custkey").select("draw", "c_custkey")


@query("train_test_split_orders", f"""
SELECT o_orderkey, CASE WHEN {_rank_sql('orders', 'o_orderkey', SEED)} <= ceil(0.2::DOUBLE * count(*) OVER ())
                   THEN 'test' ELSE 'train' END AS split FROM orders""")
def train_test_split_orders(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    return sampling.train_test_split(o, 0.2, SEED, "o_orderkey")


@query("stratified_split_orders", f"""
WITH q AS {_quota_sql('orders', 'o_orderstatus', 'ceil(0.2::DOUBLE * N)')},
r AS (SELECT o_orderkey, o_orderstatus, {_rank_sql('orders', 'o_orderkey', SEED, 'o_orderstatus')} AS rk FROM orders)
SELECT o_orderkey, o_orderstatus, CASE WHEN rk <= quota THEN 'test' ELSE 'train' END AS split
FROM r JOIN q ON r.o_orderstatus = q.o_orderstatus""".replace("SELECT o_orderkey, o_orderstatus, CASE",
                                                             "SELECT o_orderkey, r.o_orderstatus, CASE"))
def stratified_split_orders(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.train_test_split(o, 0.2, SEED, "o_orderkey", stratify="o_orderstatus")


@query("stratified_split_absolute", f"""
WITH q AS {_quota_sql('labels', 'quality', 'least(100, N)')},
r AS (SELECT doc_id, quality, {_rank_sql('labels', 'doc_id', SEED, 'quality')} AS rk FROM labels)
SELECT doc_id, r.quality, CASE WHEN rk <= quota THEN 'test' ELSE 'train' END AS split
FROM r JOIN q ON r.quality = q.quality""")
def stratified_split_absolute(spark, d):
    lab = table(spark, d, "labels").select("doc_id", "quality")
    return sampling.train_test_split(lab, 100, SEED, "doc_id", stratify="quality")


@query("nested_split_orders", f"""
WITH q1 AS {_quota_sql('orders', 'o_orderstatus', 'least(5000, N)')},
r1 AS (SELECT o_orderkey, o_orderstatus, {_rank_sql('orders', 'o_orderkey', SEED, 'o_orderstatus')} AS rk FROM orders),
s1 AS (SELECT r1.o_orderkey, r1.o_orderstatus, rk <= quota AS work FROM r1 JOIN q1 ON r1.o_orderstatus = q1.o_orderstatus),
w AS (SELECT o_orderkey, o_orderstatus FROM s1 WHERE work),
q2 AS {_quota_sql('w', 'o_orderstatus', 'least(3000, N)')},
r2 AS (SELECT o_orderkey, o_orderstatus, {_rank_sql('w', 'o_orderkey', f'{SEED}/2', 'o_orderstatus')} AS rk FROM w)
SELECT o_orderkey, CASE WHEN rk <= quota THEN 'train' ELSE 'valid' END AS split
FROM r2 JOIN q2 ON r2.o_orderstatus = q2.o_orderstatus
UNION ALL SELECT o_orderkey, 'holdout' FROM s1 WHERE NOT work""")
def nested_split_orders(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.nested_split(o, 5000, 3000, SEED, "o_orderkey", stratify="o_orderstatus").select(
        "o_orderkey", "split")


def _fold_sql(pos: str, n: str, k: int) -> str:
    base, big = f"floor({n} / {k})", f"({n} % {k})"
    return (f"CAST(CASE WHEN {pos} < {big} * ({base} + 1) THEN floor({pos} / ({base} + 1)) "
            f"ELSE {big} + floor(({pos} - {big} * ({base} + 1)) / {base}) END AS INTEGER)")


@query("folds_stratified", f"""
SELECT o_orderkey, o_orderstatus,
       CAST(({_rank_sql('orders', 'o_orderkey', SEED, 'o_orderstatus')} - 1) % 5 AS INTEGER) AS fold FROM orders""")
def folds_stratified(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.assign_folds(o, 5, "o_orderkey", "stratified", SEED, label="o_orderstatus")


@query("folds_shuffled", f"""
SELECT c_custkey, {_fold_sql(f"({_rank_sql('customer', 'c_custkey', SEED)} - 1)", 'count(*) OVER ()', 7)} AS fold
FROM customer""")
def folds_shuffled(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    return sampling.assign_folds(c, 7, "c_custkey", "shuffled", SEED)


@query("folds_contiguous", f"""
SELECT c_custkey, {_fold_sql('(row_number() OVER (ORDER BY c_custkey) - 1)', 'count(*) OVER ()', 7)} AS fold
FROM customer""")
def folds_contiguous(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    return sampling.assign_folds(c, 7, "c_custkey", "contiguous")
