import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tessera.operators.order import global_position, hash_rank, running_sum
from tessera.operators.quantiles import group_quantiles, median_of, quantiles


def test_even_count_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert median_of(df, ["x"]).first()["x"] == 2.5


def test_group_quantiles_match_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 800), "x": rng.normal(size=800).round(2)})
    pdf.loc[pdf.g == 3, "x"] = np.nan  # an all-null group
    pdf.loc[::9, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.nanvl("x", F.lit(None)))
    got = group_quantiles(df, "x", [0.1, 0.5, 0.9], groups=["g"]).orderBy("g").toPandas()
    exp = pdf.groupby("g")["x"].quantile([0.1, 0.5, 0.9]).unstack()
    for i, q in enumerate(["q0_1", "q0_5", "q0_9"]):
        a, b = got[q].to_numpy(), exp.iloc[:, i].to_numpy()
        assert np.allclose(a[:3], b[:3])
    assert got.loc[3, "q0_5"] is None or np.isnan(got.loc[3, "q0_5"])


def test_hot_group_quantile_exact(spark):
    # one group holds most rows: still exact
    df = spark.range(5000).select((F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 7)).alias("g"),
                                  (F.col("id") * 1.5).alias("x"))
    got = {r["g"]: r["q0_5"] for r in group_quantiles(df, "x", [0.5], groups=["g"]).collect()}
    pdf = df.toPandas()
    exp = pdf.groupby("g")["x"].median().to_dict()
    assert all(abs(got[k] - v) < 1e-9 for k, v in exp.items())


def test_multi_column_quantiles(spark):
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(1, 11)], "a double, b double")
    r = quantiles(df, ["a", "b"], [0.25, 0.75]).first()
    assert r["a__q0_25"] == np.quantile(np.arange(1, 11), 0.25)
    assert r["b__q0_75"] == np.quantile(np.arange(1, 11) ** 2, 0.75)


def test_hash_rank_is_md5_order(spark):
    df = spark.range(300).withColumnRenamed("id", "k")
    got = [r["k"] for r in hash_rank(df, "k", 42, out="r").orderBy("r").collect()]
    exp = sorted(range(300), key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))
    assert got == exp


def test_hash_rank_strata(spark):
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 3).alias("s"))
    r = hash_rank(df, "k", 1, strata=["s"], out="r").toPandas()
    for s, g in r.groupby("s"):
        assert sorted(g.r) == list(range(1, len(g) + 1))


def test_running_sum_matches_cumsum(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 500), "o": rng.permutation(500).astype(float),
                        "v": rng.integers(0, 10, 500)})
    got = running_sum(spark.createDataFrame(pdf), "o", ["v"], partition=["g"], partitions=8).toPandas()
    pdf = pdf.sort_values(["g", "o"])
    pdf["exp"] = pdf.groupby("g")["v"].cumsum()
    m = got.merge(pdf, on=["g", "o"])
    assert (m["v_cum"] == m["exp"]).all()


def test_global_position_strings(spark):
    words = [f"w{i:04d}" for i in np.random.default_rng(1).permutation(400)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = global_position(df, "w", partitions=5).toPandas().sort_values("_pos")
    assert list(got.w) == sorted(words)
    assert list(got._pos) == list(range(400))
