"""Catalogue part 1: load, project, clean, derive, encode (P, C, F, E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as fx
from ..operators import clean, columns, encode
from ..operators.stats import rate_by
from .frames import (NULLED_LINEITEM_SQL, RK, hdigit, hdigit_sql, null_if_hash, null_if_hash_sql,
                     nulled_lineitem, round_doubles, table)
from .registry import query

# ------------------------------------------------------------------ flagship
PRICE_EDGES = [0, 100000, 200000, 300000, 600000]


def _cut_sql(x, edges, default=0):
    parts = []
    for i in range(len(edges) - 1):
        lo = f"{x} >= {edges[i]}" if i == 0 else f"{x} > {edges[i]}"
        parts.append(f"WHEN {lo} AND {x} <= {edges[i + 1]} THEN {i}")
    return f"CASE {' '.join(parts)} ELSE {default} END"


def _rate_sql(y, n="count(*)"):
    r = f"avg({y})"
    half = f"1.96 * sqrt({r} * (1 - {r}) / {n})"
    return (f"{n} AS n, round({r}, 6) AS rate, round(greatest({r} - {half}, 0.0), 6) AS ci_low, "
            f"round(least({r} + {half}, 1.0), 6) AS ci_high")


def survival_by_price_bin(spark, d):
    """Minimum slice, workload B's question on orders x customer: plant
    missing prices, fill by segment median (global fallback), bin with
    right-closed edges, map status 'F' to the outcome, rate per bin."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    base = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "c_mktsegment", "o_orderstatus",
        null_if_hash("o_totalprice", "o_orderkey", "p", "3").alias("price"))
    filled = clean.fill_group_median(base, "price", "c_mktsegment", fallback=True)
    binned = filled.select(fx.cut("price", PRICE_EDGES, default=0).alias("price_bin"),
                           fx.map_values("o_orderstatus", {"F": 1}, default=0).alias("survived"))
    return round_doubles(rate_by(binned, "price_bin", "survived"))


SURVIVAL_SQL = f"""
WITH base AS (
  SELECT o.o_orderkey, c.c_mktsegment, o.o_orderstatus,
         {null_if_hash_sql('o.o_totalprice', 'o.o_orderkey', 'p', '3')} AS price
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
gm AS (SELECT c_mktsegment, quantile_cont(price, 0.5) AS gmed FROM base GROUP BY c_mktsegment),
gl AS (SELECT quantile_cont(price, 0.5) AS gall FROM base),
f AS (SELECT COALESCE(b.price, gm.gmed, gl.gall) AS price, b.o_orderstatus
      FROM base b LEFT JOIN gm ON b.c_mktsegment = gm.c_mktsegment CROSS JOIN gl),
bn AS (SELECT {_cut_sql('price', PRICE_EDGES)} AS price_bin,
              CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS survived FROM f)
SELECT price_bin, {_rate_sql('survived')} FROM bn GROUP BY price_bin"""

query("survival_by_price_bin", SURVIVAL_SQL)(survival_by_price_bin)


# ------------------------------------------------------------------ P
@query("select_numeric_features", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders""")
def select_numeric_features(spark, d):
    o = table(spark, d, "orders")
    numeric = columns.columns_of_type(o, "numeric")
    kept = columns.select_features(o, include=numeric, keep=["o_orderkey"])
    return columns.drop_columns(kept, [], strict=True)


@query("drop_columns_ignore_missing", """
SELECT c_custkey, c_nationkey, c_acctbal FROM customer""")
def drop_columns_ignore_missing(spark, d):
    c = table(spark, d, "customer")
    return columns.drop_columns(c, ["c_name", "c_mktsegment", "no_such_column"], strict=False)


@query("drop_null_rows", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity
FROM ({NULLED_LINEITEM_SQL}) WHERE l_quantity IS NOT NULL""")
def drop_null_rows(spark, d):
    li = nulled_lineitem(spark, d)
    return columns.drop_rows_null(li, ["l_quantity"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("drop_outlier_keys", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)""")
def drop_outlier_keys(spark, d):
    o = table(spark, d, "orders")
    top = clean.top_k(o, "o_totalprice", 5, tiebreak=["o_orderkey"]).select("o_orderkey")
    return columns.drop_keys(o, "o_orderkey", top).select("o_orderkey", "o_totalprice")


@query("top_k_outliers", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def top_k_outliers(spark, d):
    return clean.top_k(table(spark, d, "orders"), "o_totalprice", 10, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("head_rows", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 20""")
def head_rows(spark, d):
    return columns.head(table(spark, d, "orders"), 20, "o_orderkey").select("o_orderkey", "o_custkey", "o_orderstatus")


_CUST_TYPES = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
               ("c_mktsegment", "string")]


@query("table_info", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null, count(*) AS \"rows\" "
    f"FROM customer" for i, (c, t) in enumerate(_CUST_TYPES)))
def table_info(spark, d):
    return columns.table_info(table(spark, d, "customer"))


@query("cast_best_effort", """
SELECT o_orderkey, o_orderpriority, CAST(trunc(o_totalprice) AS INTEGER) AS o_totalprice FROM orders""")
def cast_best_effort(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return columns.cast_columns(o, {"o_orderpriority": "int", "o_totalprice": "int"}, on_error="ignore")


@query("flatten_params", """
SELECT p_partkey, CAST(p_size AS DOUBLE) AS param_size, p_retailprice AS param_retail FROM part""")
def flatten_params(spark, d):
    p = table(spark, d, "part").select(
        "p_partkey", F.create_map(F.lit("size"), F.col("p_size").cast("double"),
                                  F.lit("retail"), F.col("p_retailprice")).alias("params"))
    return columns.flatten_params(p, "params", prefix="param_")


# ------------------------------------------------------------------ C
_PROFILE_COLS = ["l_orderkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate"]


@query("missing_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS total, "
    f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS percent FROM ({NULLED_LINEITEM_SQL})"
    for c in _PROFILE_COLS))
def missing_profile(spark, d):
    return round_doubles(clean.missing_profile(nulled_lineitem(spark, d), _PROFILE_COLS))


@query("null_total", f"""
SELECT CAST(sum(t) AS BIGINT) AS null_total, max(t) AS null_max FROM (
  {' UNION ALL '.join(f"SELECT count(*) FILTER (WHERE {c} IS NULL) AS t FROM ({NULLED_LINEITEM_SQL})"
                      for c in _PROFILE_COLS)})""")
def null_total(spark, d):
    return clean.null_total(nulled_lineitem(spark, d), _PROFILE_COLS)


@query("drop_sparse_columns", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_linestatus, l_quantity, l_discount, l_tax
FROM ({NULLED_LINEITEM_SQL}) WHERE {hdigit_sql(RK, 'split')} >= '4'""")
def drop_sparse_columns(spark, d):
    li = nulled_lineitem(spark, d)
    rk = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    train = li.where(hdigit(rk, "split") < "4")
    test = li.where(hdigit(rk, "split") >= "4")
    _, (test2,) = clean.drop_sparse_columns(train, [test], max_share=0.4)
    return test2.drop("l_shipdate")


@query("fill_literal", f"""
SELECT l_orderkey, l_linenumber, COALESCE(l_returnflag, 'None') AS l_returnflag,
       COALESCE(l_quantity, 0.0) AS l_quantity FROM ({NULLED_LINEITEM_SQL})""")
def fill_literal(spark, d):
    li = nulled_lineitem(spark, d)
    return clean.fill_literal(li, {"l_returnflag": "None", "l_quantity": 0}).select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


@query("fill_mean", f"""
WITH t AS ({NULLED_LINEITEM_SQL})
SELECT l_orderkey, l_linenumber, round(COALESCE(l_quantity, (SELECT avg(l_quantity) FROM t)), 6) AS l_quantity,
       round(COALESCE(l_tax, (SELECT avg(l_tax) FROM t)), 6) AS l_tax FROM t""")
def fill_mean(spark, d):
    li = nulled_lineitem(spark, d)
    return round_doubles(clean.fill_stat(li, ["l_quantity", "l_tax"], "mean").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax"))


@query("fill_median_train_to_test", f"""
WITH t AS ({NULLED_LINEITEM_SQL}),
tr AS (SELECT * FROM t WHERE {hdigit_sql(RK, 'split')} < '4'),
te AS (SELECT * FROM t WHERE {hdigit_sql(RK, 'split')} >= '4')
SELECT l_orderkey, l_linenumber,
  round(COALESCE(l_discount, (SELECT quantile_cont(l_discount, 0.5) FROM tr)), 6) AS l_discount,
  round(COALESCE(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM tr)), 6) AS l_quantity FROM te""")
def fill_median_train_to_test(spark, d):
    li = nulled_lineitem(spark, d)
    rk = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    train, test = li.where(hdigit(rk, "split") < "4"), li.where(hdigit(rk, "split") >= "4")
    out = clean.fill_stat(test, ["l_discount", "l_quantity"], "median", fit_on=train)
    return round_doubles(out.select("l_orderkey", "l_linenumber", "l_discount", "l_quantity"))


@query("fill_mode", f"""
WITH t AS ({NULLED_LINEITEM_SQL}),
mf AS (SELECT l_returnflag AS v FROM t WHERE l_returnflag IS NOT NULL GROUP BY 1
       ORDER BY count(*) DESC, v LIMIT 1),
mt AS (SELECT l_tax AS v FROM t WHERE l_tax IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1)
SELECT l_orderkey, l_linenumber, COALESCE(l_returnflag, (SELECT v FROM mf)) AS l_returnflag,
       round(COALESCE(l_tax, (SELECT v FROM mt)), 6) AS l_tax FROM t""")
def fill_mode(spark, d):
    li = nulled_lineitem(spark, d)
    return round_doubles(clean.fill_stat(li, ["l_returnflag", "l_tax"], "mode").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_tax"))


_GM_Q = f"CASE WHEN l_linenumber = 7 THEN NULL ELSE {null_if_hash_sql('l_quantity', RK, 'q', '6')} END"


@query("fill_group_median", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, {_GM_Q} AS q FROM lineitem),
g AS (SELECT l_linenumber, quantile_cont(q, 0.5) AS m FROM t GROUP BY l_linenumber),
a AS (SELECT quantile_cont(q, 0.5) AS m FROM t)
SELECT t.l_orderkey, t.l_linenumber, round(COALESCE(t.q, g.m, a.m), 6) AS q
FROM t LEFT JOIN g ON t.l_linenumber = g.l_linenumber CROSS JOIN a""")
def fill_group_median(spark, d):
    li = table(spark, d, "lineitem")
    rk = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    t = li.select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") == 7, F.lit(None))
                  .otherwise(null_if_hash("l_quantity", rk, "q", "6")).alias("q"))
    return round_doubles(clean.fill_group_median(t, "q", "l_linenumber", fallback=True))


@query("group_transform_mean", """
SELECT c_custkey, c_mktsegment, round(c_acctbal, 6) AS c_acctbal,
       round(avg(c_acctbal) OVER (PARTITION BY c_mktsegment), 6) AS c_acctbal_mean FROM customer""")
def group_transform_mean(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return round_doubles(clean.group_transform(c, "c_acctbal", "c_mktsegment", "mean")
                         .select("c_custkey", "c_mktsegment", "c_acctbal", "c_acctbal_mean"))


_EV_VALUE = null_if_hash_sql("value", "event_id", "v", "6")


@query("forward_fill_by_user", f"""
SELECT event_id, user_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM (SELECT event_id, user_id, ts, {_EV_VALUE} AS v FROM events)""")
def forward_fill_by_user(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts",
                                         null_if_hash("value", "event_id", "v", "6").alias("value"))
    return clean.forward_fill(e, ["value"], ["ts", "event_id"], partition_by=["user_id"]).select(
        "event_id", "user_id", "value")


@query("forward_fill_global", f"""
SELECT event_id, last_value(v IGNORE NULLS) OVER (ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM (SELECT event_id, ts, {_EV_VALUE} AS v FROM events)""")
def forward_fill_global(spark, d):
    e = table(spark, d, "events").select("event_id", "ts",
                                         null_if_hash("value", "event_id", "v", "6").alias("value"))
    return clean.forward_fill(e, ["value"], ["ts", "event_id"]).select("event_id", "value")


def _nonfinite_lineitem(spark, d):
    li = table(spark, d, "lineitem")
    rk = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    h = hdigit(rk, "nf")
    x = F.when(h == "0", F.lit(float("inf"))).when(h == "1", F.lit(float("-inf"))) \
        .when(h == "2", F.lit(float("nan"))).when(h == "3", F.lit(None)).otherwise(F.col("l_extendedprice"))
    return li.select("l_orderkey", "l_linenumber", x.alias("price"), "l_quantity")


_NF_SQL = f"""SELECT l_orderkey, l_linenumber, l_quantity,
  CASE {hdigit_sql(RK, 'nf')} WHEN '0' THEN 'inf'::DOUBLE WHEN '1' THEN '-inf'::DOUBLE
       WHEN '2' THEN 'nan'::DOUBLE WHEN '3' THEN NULL ELSE l_extendedprice END AS price FROM lineitem"""


@query("nonfinite_report", f"""
SELECT count(*) FILTER (WHERE price IS NULL OR isnan(price)) AS nan_count,
       count(*) FILTER (WHERE isinf(price)) AS inf_count FROM ({_NF_SQL})""")
def nonfinite_report(spark, d):
    return clean.nonfinite_report(_nonfinite_lineitem(spark, d), ["price", "l_quantity"])


@query("clean_nonfinite", f"""
WITH t AS (SELECT l_orderkey, l_linenumber,
             CASE WHEN isnan(price) OR isinf(price) THEN NULL ELSE price END AS price FROM ({_NF_SQL}))
SELECT l_orderkey, l_linenumber, round(COALESCE(price, (SELECT quantile_cont(price, 0.5) FROM t)), 6) AS price
FROM t""")
def clean_nonfinite(spark, d):
    t = _nonfinite_lineitem(spark, d)
    return round_doubles(clean.clean_nonfinite(t, ["price"]).select("l_orderkey", "l_linenumber", "price"))


# ------------------------------------------------------------------ F
@query("derive_features", f"""
SELECT l_orderkey, l_linenumber,
  l_quantity + l_linenumber + 1 AS family_size,
  CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS is_alone,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_returned,
  CASE WHEN {hdigit_sql(RK, 'cab')} < '5' THEN 0 ELSE 1 END AS has_cabin,
  round(ln(1 + l_extendedprice), 6) AS log_price,
  round(exp(ln(1 + l_extendedprice)) - 1, 4) AS price_back,
  CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS high_discount
FROM lineitem""")
def derive_features(spark, d):
    li = table(spark, d, "lineitem")
    rk = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    cabin = null_if_hash(F.lit("C"), rk, "cab", "5")
    out = fx.derive(li, {
        "family_size": F.col("l_quantity") + F.col("l_linenumber") + 1,
        "is_alone": (F.col("l_linenumber") == 1).cast("int"),
        "is_returned": fx.flag_equals("l_returnflag", "R"),
        "has_cabin": fx.presence_flag(cabin),
        "log_price": F.round(fx.log_target("l_extendedprice"), 6),
        "price_back": F.round(fx.inv_log_target(fx.log_target("l_extendedprice")), 4),
        "high_discount": fx.apply_threshold("l_discount", 0.05),
    })
    return out.select("l_orderkey", "l_linenumber", "family_size", "is_alone", "is_returned", "has_cabin",
                      "log_price", "price_back", "high_discount")


# fixed values: title groups used on the documents table
TITLE_COLLAPSE = {"Article": ["the", "le", "la", "der", "de"], "Rare": ["et", "ha", "ea", "edouhe"]}
TITLE_CODES = {"anea": 0, "Article": 1, "of": 2, "to": 3, "in": 4, "Rare": 5}
TITLE_PATTERN = r" ([A-Za-z]+)\."


@query("extract_map_title", f"""
WITH t AS (SELECT doc_id, NULLIF(regexp_extract(text, '{TITLE_PATTERN}', 1), '') AS raw FROM documents),
c AS (SELECT doc_id, raw, CASE {' '.join(f"WHEN raw = '{o}' THEN '{n}'" for n, olds in TITLE_COLLAPSE.items() for o in olds)}
        ELSE raw END AS title FROM t)
SELECT doc_id, title, COALESCE(CASE {' '.join(f"WHEN title = '{k}' THEN {v}" for k, v in TITLE_CODES.items())} END, 6)
       AS title_code FROM c""")
def extract_map_title(spark, d):
    docs = table(spark, d, "documents")
    t = docs.select("doc_id", fx.extract("text", TITLE_PATTERN).alias("raw"))
    t = t.withColumn("title", fx.collapse_values("raw", TITLE_COLLAPSE))
    return t.select("doc_id", "title", fx.map_values("title", TITLE_CODES, default=6).alias("title_code"))


RETAIL_EDGES = [900, 1000, 1100, 1500, 2000]


@query("cut_retail_price", f"""
SELECT p_partkey, {_cut_sql('p_retailprice', RETAIL_EDGES)} AS price_bin FROM part""")
def cut_retail_price(spark, d):
    return table(spark, d, "part").select("p_partkey", fx.cut("p_retailprice", RETAIL_EDGES, default=0).alias("price_bin"))


@query("minmax_score", """
SELECT event_id, round((value - (SELECT min(value) FROM events)) /
       ((SELECT max(value) FROM events) - (SELECT min(value) FROM events)), 6) AS value_scaled FROM events""")
def minmax_score(spark, d):
    e = table(spark, d, "events").select("event_id", "value")
    return round_doubles(fx.minmax_score(e, "value", "value_scaled").select("event_id", "value_scaled"))


@query("clean_model_names", """
SELECT p_partkey, translate(p_brand || ' ' || p_type || '/' || p_name, ' /', '__') AS file_name FROM part""")
def clean_model_names(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", fx.clean_name(F.concat_ws("", "p_brand", F.lit(" "), "p_type", F.lit("/"), "p_name"))
                    .alias("file_name"))


# ------------------------------------------------------------------ E
_STATUS_NULL = null_if_hash_sql("o_orderstatus", "o_orderkey", "st", "2")
_SPLIT_O = hdigit_sql("o_orderkey", "split")


@query("one_hot_train_vocab", f"""
SELECT o_orderkey, CASE WHEN st = 'F' THEN 1 ELSE 0 END AS st_F, CASE WHEN st = 'O' THEN 1 ELSE 0 END AS st_O
FROM (SELECT o_orderkey, {_STATUS_NULL} AS st FROM orders WHERE {_SPLIT_O} >= '4')""")
def one_hot_train_vocab(spark, d):
    o = table(spark, d, "orders")
    split = hdigit("o_orderkey", "split") < "4"
    t = o.select("o_orderkey", "o_orderstatus", null_if_hash("o_orderstatus", "o_orderkey", "st", "2").alias("st"),
                 split.alias("is_train"))
    # the train vocabulary lacks 'P' on purpose: test rows with 'P' encode as all zeros
    train = t.where(F.col("is_train") & (F.col("o_orderstatus") != "P"))
    test = t.where(~F.col("is_train"))
    return encode.one_hot(test.select("o_orderkey", "st"), ["st"], fit_on=train)


@query("label_encode_union", """
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS c_mktsegment,
       CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS c_name FROM customer""")
def label_encode_union(spark, d):
    c = table(spark, d, "customer")
    train = c.where(hdigit("c_custkey", "split") < "8")
    test = c.where(hdigit("c_custkey", "split") >= "8")
    both = train.unionByName(test)
    return encode.label_encode(both.select("c_custkey", "c_mktsegment", "c_name"), ["c_mktsegment", "c_name"],
                               fit_on=both)


_SPLIT_L = hdigit_sql(RK, "split")


@query("standard_scale_train_fit", f"""
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp,
                  stddev_pop(l_extendedprice) AS sp FROM lineitem WHERE {_SPLIT_L} < '4')
SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) AS l_quantity,
       round((l_extendedprice - mp) / sp, 6) AS l_extendedprice FROM lineitem CROSS JOIN s""")
def standard_scale_train_fit(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    rk = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    train = li.where(hdigit(rk, "split") < "4")
    return round_doubles(encode.standard_scale(li, ["l_quantity", "l_extendedprice"], fit_on=train))


@query("robust_scale_train_fit", f"""
WITH s AS (SELECT quantile_cont(l_quantity, 0.25) AS a1, quantile_cont(l_quantity, 0.5) AS m1,
                  quantile_cont(l_quantity, 0.75) AS b1, quantile_cont(l_extendedprice, 0.25) AS a2,
                  quantile_cont(l_extendedprice, 0.5) AS m2, quantile_cont(l_extendedprice, 0.75) AS b2
           FROM lineitem WHERE {_SPLIT_L} < '4')
SELECT l_orderkey, l_linenumber, round((l_quantity - m1) / (b1 - a1), 6) AS l_quantity,
       round((l_extendedprice - m2) / (b2 - a2), 6) AS l_extendedprice FROM lineitem CROSS JOIN s""")
def robust_scale_train_fit(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    rk = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    train = li.where(hdigit(rk, "split") < "4")
    return round_doubles(encode.robust_scale(li, ["l_quantity", "l_extendedprice"], fit_on=train))
