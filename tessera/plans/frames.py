"""Derived input frames shared by the query catalogue, each written twice:
as a Spark plan over the driver's tables and as the equivalent SQL text.

The driver's tables hold no NULLs, so missing values are planted
deterministically from ``md5(salt ':' key)``: a row loses a value when the
first hex digit of its hash is below a cut-off. Nothing is filtered or
capped; every row of every table is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import hash_hex


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hdigit(key, salt) -> F.Column:
    return F.substring(hash_hex(key, salt), 1, 1)


def hdigit_sql(key: str, salt: str) -> str:
    return f"substr(md5('{salt}:' || CAST({key} AS VARCHAR)), 1, 1)"


def null_if_hash(col, key, salt: str, below: str) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(hdigit(key, salt) < F.lit(below), F.lit(None)).otherwise(c)


def null_if_hash_sql(col: str, key: str, salt: str, below: str) -> str:
    return f"CASE WHEN {hdigit_sql(key, salt)} < '{below}' THEN NULL ELSE {col} END"


def uniform(key, salt) -> F.Column:
    """Deterministic U[0,1] from 4 hex digits of the hash."""
    return F.conv(F.substring(hash_hex(key, salt), 1, 4), 16, 10).cast("double") / 65535.0


def uniform_sql(key: str, salt: str) -> str:
    return f"(('0x' || substr(md5('{salt}:' || CAST({key} AS VARCHAR)), 1, 4))::INTEGER / 65535.0)"


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Presentation rounding of every double column (both engines sum in
    different orders; six decimals hide that)."""
    from pyspark.sql import types as T
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


# ------------------------------------------------------------- lineitem with holes
RK = "l_orderkey * 100 + l_linenumber"


def nulled_lineitem(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    rk = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_linestatus", "l_shipdate",
        null_if_hash("l_quantity", rk, "q", "2").alias("l_quantity"),
        null_if_hash("l_discount", rk, "d", "5").alias("l_discount"),
        null_if_hash("l_tax", rk, "t", "1").alias("l_tax"),
        null_if_hash("l_returnflag", rk, "r", "8").alias("l_returnflag"))


NULLED_LINEITEM_SQL = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_linestatus, l_shipdate,
  {null_if_hash_sql('l_quantity', RK, 'q', '2')} AS l_quantity,
  {null_if_hash_sql('l_discount', RK, 'd', '5')} AS l_discount,
  {null_if_hash_sql('l_tax', RK, 't', '1')} AS l_tax,
  {null_if_hash_sql('l_returnflag', RK, 'r', '8')} AS l_returnflag
FROM lineitem"""


# ------------------------------------------------------------- scored orders
def scored_orders(spark, sf_dir) -> DataFrame:
    """Orders with a 0/1 label (status 'F') and three deterministic model
    scores in [0, 1]: price-based, hash noise, and an informative mix."""
    o = table(spark, sf_dir, "orders")
    y = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    s1 = F.round(F.col("o_totalprice") / 500000.0, 3)
    s2 = F.round(uniform("o_orderkey", "s2"), 3)
    s3 = F.round(F.when(y == 1, 0.35 + 0.6 * uniform("o_orderkey", "s2"))
                 .otherwise(0.05 + 0.6 * F.col("o_totalprice") / 500000.0), 3)
    return o.select("o_orderkey", "o_custkey", "o_totalprice", y.alias("label"),
                    s1.alias("s_price"), s2.alias("s_noise"), s3.alias("s_mix"))


SCORED_ORDERS_SQL = f"""
SELECT o_orderkey, o_custkey, o_totalprice,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
  round(o_totalprice / 500000.0, 3) AS s_price,
  round({uniform_sql('o_orderkey', 's2')}, 3) AS s_noise,
  round(CASE WHEN o_orderstatus = 'F' THEN 0.35 + 0.6 * {uniform_sql('o_orderkey', 's2')}
             ELSE 0.05 + 0.6 * o_totalprice / 500000.0 END, 3) AS s_mix
FROM orders"""

MODELS = ["s_price", "s_noise", "s_mix"]


def long_scores(spark, sf_dir) -> DataFrame:
    """(o_orderkey, label, model, score, prediction) -- one row per model."""
    s = scored_orders(spark, sf_dir)
    stacked = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("score")) for m in MODELS]))
    return s.select("o_orderkey", "label", stacked.alias("_m")).select(
        "o_orderkey", "label", "_m.model", "_m.score",
        (F.col("_m.score") >= 0.5).cast("int").alias("prediction"))


LONG_SCORES_SQL = f"""
SELECT o_orderkey, label, model, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM (
  SELECT o_orderkey, label, 's_price' AS model, s_price AS score FROM ({SCORED_ORDERS_SQL})
  UNION ALL SELECT o_orderkey, label, 's_noise', s_noise FROM ({SCORED_ORDERS_SQL})
  UNION ALL SELECT o_orderkey, label, 's_mix', s_mix FROM ({SCORED_ORDERS_SQL}))"""


# ------------------------------------------------------------- regression predictions
REG_MODELS = ["r_scale", "r_shift", "r_flat"]


def regression_preds(spark, sf_dir) -> DataFrame:
    """(o_orderkey, y, model, prediction): y = price in 100k units and
    three deterministic 'regressors' of different quality."""
    o = table(spark, sf_dir, "orders")
    y = F.col("o_totalprice") / 100000.0
    preds = {"r_scale": F.round(y * (0.8 + 0.4 * uniform("o_orderkey", "ra")), 6),
             "r_shift": F.round(y + (uniform("o_orderkey", "rb") - 0.5), 6),
             "r_flat": F.lit(2.5)}
    stacked = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), p.alias("prediction")) for m, p in preds.items()]))
    return o.select("o_orderkey", y.alias("y"), stacked.alias("_m")).select("o_orderkey", "y", "_m.model", "_m.prediction")


REG_PREDS_SQL = f"""
SELECT o_orderkey, o_totalprice / 100000.0 AS y, 'r_scale' AS model,
       round(o_totalprice / 100000.0 * (0.8 + 0.4 * {uniform_sql('o_orderkey', 'ra')}), 6) AS prediction FROM orders
UNION ALL SELECT o_orderkey, o_totalprice / 100000.0, 'r_shift',
       round(o_totalprice / 100000.0 + ({uniform_sql('o_orderkey', 'rb')} - 0.5), 6) FROM orders
UNION ALL SELECT o_orderkey, o_totalprice / 100000.0, 'r_flat', 2.5 FROM orders"""


# ------------------------------------------------------------- modelling table
def model_frame(spark, sf_dir) -> DataFrame:
    """Heart-disease-sized modelling table from lineitem (600k rows at
    sf0.1): unique string key, four numeric features and a planted binary
    label (linear signal + logistic noise from the key's hash), plus a
    regression target."""
    li = table(spark, sf_dir, "lineitem")
    rid = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    u = (F.conv(F.substring(hash_hex(rid, "noise"), 1, 6), 16, 10).cast("double") + 0.5) / 16777216.0
    noise = F.log(u / (1 - u))
    q, disc, tax = F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100
    price = F.col("l_extendedprice") / 10000.0
    signal = 0.12 * (q - 25.5) - 0.5 * (disc - 5) + 0.45 * (tax - 4)
    return li.select(rid.alias("rid"), q.alias("q"), disc.alias("disc"), tax.alias("tax"), price.alias("price"),
                     (signal + noise > 0).cast("int").alias("label"),
                     (2 * q / 50 - 3 * disc / 10 + 0.5 * price + 0.3 * noise).alias("y_reg"))


MODEL_FEATURES = ["q", "disc", "tax", "price"]

MODEL_FRAME_SQL = """
SELECT rid, q, disc, tax, price, CASE WHEN signal + noise > 0 THEN 1 ELSE 0 END AS label,
       2 * q / 50 - 3 * disc / 10 + 0.5 * price + 0.3 * noise AS y_reg FROM (
  SELECT rid, q, disc, tax, price, 0.12 * (q - 25.5) - 0.5 * (disc - 5) + 0.45 * (tax - 4) AS signal,
         ln(u / (1 - u)) AS noise FROM (
    SELECT rid, l_quantity AS q, l_discount * 100 AS disc, l_tax * 100 AS tax, l_extendedprice / 10000.0 AS price,
           ((('0x' || substr(md5('noise:' || rid), 1, 6))::INTEGER) + 0.5) / 16777216.0 AS u FROM (
      SELECT *, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' ||
                CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS rid FROM lineitem)))"""
