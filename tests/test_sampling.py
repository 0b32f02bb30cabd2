from pyspark.sql import functions as F

from tessera.operators import sampling


def test_sample_n_exact_and_capped(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert sampling.sample_n(df, 150, 7, "k").count() == 150
    assert sampling.sample_n(df, 5000, 7, "k").count() == 1000
    a = {r.k for r in sampling.sample_n(df, 150, 7, "k").collect()}
    b = {r.k for r in sampling.sample_n(df.repartition(13), 150, 7, "k").collect()}
    assert a == b  # independent of partitioning


def test_bootstrap(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    b = sampling.bootstrap_n(df, 500, 3, "k")
    assert b.count() == 500
    assert b.select("k").distinct().count() <= 50


def test_split_exact_counts_disjoint(spark):
    df = spark.range(1001).withColumnRenamed("id", "k")
    s = sampling.train_test_split(df, 0.2, 1, "k").toPandas()
    assert (s.split == "test").sum() == 201 and len(s) == 1001 and s.k.is_unique


def test_stratified_quotas(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 10 < 3).cast("int").alias("y"))
    s = sampling.train_test_split(df, 0.25, 1, "k", stratify="y").toPandas()
    t = s[s.split == "test"]
    assert len(t) == 250 and (t.y == 1).sum() == 75
    abs_ = sampling.train_test_split(df, 101, 1, "k", stratify="y").toPandas()
    assert (abs_.split == "test").sum() == 101


def test_nested_split(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 2).cast("int").alias("y"))
    s = sampling.nested_split(df, 400, 300, 1, "k", stratify="y").toPandas()
    assert s.split.value_counts().to_dict() == {"holdout": 600, "train": 300, "valid": 100}


def test_folds(spark):
    df = spark.range(103).select(F.col("id").alias("k"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    for mode in ("shuffled", "contiguous"):
        f = sampling.assign_folds(df, 5, "k", mode, seed=2).toPandas()
        assert sorted(f.fold.value_counts().tolist(), reverse=True) == [21, 21, 21, 20, 20]
    c = sampling.assign_folds(df, 5, "k", "contiguous").toPandas().sort_values("k")
    assert c.fold.is_monotonic_increasing
    st = sampling.assign_folds(df, 5, "k", "stratified", seed=2, label="y").toPandas()
    per = st.groupby(["fold"])["y"].sum()
    assert per.max() - per.min() <= 1


def test_union_split_roundtrip(spark):
    a = spark.createDataFrame([(1, 0)], "k int, y int")
    b = spark.createDataFrame([(2,)], "k int")
    u = sampling.union_tagged({"train": a, "test": b})
    assert u.where(F.col("y").isNull()).count() == 1
    parts = sampling.split_by_tag(u)
    assert parts["test"].count() == 1 and parts["train"].count() == 1
