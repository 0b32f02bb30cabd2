"""Catalogue part 8: sources and sinks written, read back and compared with the original tables (S1, S3-S6), drops by count."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..models import moments
from ..operators import clean
from ..session import ensure_checkpoint_dir
from ..sources import io
from .frames import MODEL_FRAME_SQL, NULLED_LINEITEM_SQL, SCORED_ORDERS_SQL, hdigit, hdigit_sql, model_frame, nulled_lineitem, round_doubles, scored_orders, table
from .registry import query


def _folder(spark) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/written-{uuid.uuid4().hex}"


@query("csv_roundtrip_supplier", """
SELECT s_suppkey, 'Say "' || s_name || '", twice' AS quoted, CAST(s_acctbal AS DOUBLE) AS s_acctbal,
       CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_name END AS hole FROM supplier""")
def csv_roundtrip_supplier(spark, d):
    """S1 + S3: quotes, commas and nulls through a CSV file."""
    s = table(spark, d, "supplier")
    out = s.select("s_suppkey", F.concat(F.lit('Say "'), "s_name", F.lit('", twice')).alias("quoted"), F.col("s_acctbal").cast("double"),
                   F.when(F.col("s_suppkey") % 7 != 0, F.col("s_name")).alias("hole"))
    path = _folder(spark)
    out.write.option("header", True).option("escape", '"').csv(path)
    return io.read_csv(spark, path, "s_suppkey long, quoted string, s_acctbal double, hole string")


@query("submission_roundtrip", f"SELECT o_orderkey, CASE WHEN s_mix >= 0.5 THEN 1 ELSE 0 END AS prediction FROM ({SCORED_ORDERS_SQL})")
def submission_roundtrip(spark, d):
    """S3: a submission file of key and class."""
    path = _folder(spark)
    io.write_submission(scored_orders(spark, d).withColumn("prediction", (F.col("s_mix") >= 0.5).cast("int")), path, ["o_orderkey", "prediction"])
    return io.read_csv(spark, path, "o_orderkey long, prediction int")


_RESULTS_SQL = """SELECT o_orderstatus || ' / ' || o_orderpriority AS model, avg(o_totalprice) AS f1, CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY o_orderstatus, o_orderpriority"""


def _results(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy("o_orderstatus", "o_orderpriority").agg(F.avg("o_totalprice").alias("f1"), F.count(F.lit(1)).alias("n")) \
        .select(F.concat_ws(" / ", "o_orderstatus", "o_orderpriority").alias("model"), "f1", "n")


@query("json_results_roundtrip", f"SELECT model, round(f1, 6) AS f1, n, CAST(n AS VARCHAR) AS param FROM ({_RESULTS_SQL})")
def json_results_roundtrip(spark, d):
    """Records with a nested map through JSON Lines."""
    path = _folder(spark)
    io.write_results(_results(spark, d).withColumn("params", F.create_map(F.lit("n"), F.col("n").cast("string"))), path)
    back = spark.read.schema("model string, f1 double, n long, params map<string,string>").json(path)
    return round_doubles(back.select("model", "f1", "n", F.col("params")["n"].alias("param")))


@query("result_log_roundtrip", f"""
SELECT model, CAST(2 AS BIGINT) AS records, round(2 * f1, 6) AS f1_sum FROM ({_RESULTS_SQL})""")
def result_log_roundtrip(spark, d):
    """Two runs appended to one log."""
    path = _folder(spark)
    for _ in range(2):
        io.append_results(_results(spark, d), path)
    log = io.read_results(spark, path, "model string, f1 double, n long")
    return round_doubles(log.groupBy("model").agg(F.count(F.lit(1)).alias("records"), F.sum("f1").alias("f1_sum")))


@query("saved_model_scores", f"""
WITH m AS (SELECT * FROM ({MODEL_FRAME_SQL})),
s AS (SELECT avg(q) AS mx, avg(y_reg) AS my, covar_pop(q, y_reg) * count(*) / (var_pop(q) * count(*) + 10.0) AS w
      FROM m WHERE {hdigit_sql('rid', 'saved')} < 'c')
SELECT rid, round(my + w * (q - mx), 6) AS prediction FROM m CROSS JOIN s WHERE {hdigit_sql('rid', 'saved')} >= 'c'""")
def saved_model_scores(spark, d):
    """S6 + D3: a model fitted, saved, loaded and applied."""
    m = model_frame(spark, d)
    is_train, path = hdigit("rid", "saved") < "c", _folder(spark)
    io.save_model(moments.fit_moments(m.where(is_train), ["q"], "y_reg", "ridge", alpha=10.0), path)
    return round_doubles(io.load_model(path).transform(m.where(~is_train)).select("rid", "prediction"))


@query("drop_columns_by_null_count", f"""
SELECT l_orderkey, l_linenumber, l_tax, l_quantity FROM ({NULLED_LINEITEM_SQL})""")
def drop_columns_by_null_count(spark, d):
    """Columns with more missing cells than a fifth of the rows' number go."""
    li = nulled_lineitem(spark, d).select("l_orderkey", "l_linenumber", "l_tax", "l_quantity", "l_discount", "l_returnflag")
    out = clean.drop_sparse_columns(li, max_nulls=li.count() // 5)
    return out[0] if isinstance(out, (list, tuple)) else out
