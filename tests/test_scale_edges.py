import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tessera.models import base, bayes, linear, trees
from tessera.operators import clean, encode, order, sampling
from tessera.session import ensure_checkpoint_dir
from tessera.sources import io


def test_positions_beyond_the_range_sample(spark):
    n = 300_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    p = order.global_position(df, "k", partitions=16)
    assert p.where(F.col("_pos") != F.col("k")).count() == 0 and p.select("_pos").distinct().count() == n
    f = {r.fold: r["count"] for r in sampling.assign_folds(df, 7, "k", "contiguous").groupBy("fold").count().collect()}
    assert sorted(f) == list(range(7)) and max(f.values()) - min(f.values()) <= 1


def test_ranges_follow_the_rows(spark):
    df = spark.range(60_000).withColumn("v", F.lit(1))
    few = order.range_split(df, [F.col("id")]).select("_rng").distinct().count()
    many = order.range_split(df, [F.col("id")], rows_per_range=2_000).select("_rng").distinct().count()
    assert few <= 8 and many >= 25
    s = order.running_sum(df, "id", ["v"], partitions=13).where(F.col("v_cum") != F.col("id") + 1)
    assert s.count() == 0


def test_null_keys_and_strata_stay(spark):
    df = spark.range(100).select(F.when(F.col("id") % 5 != 0, F.col("id")).alias("k"),
                                 F.when(F.col("id") % 4 != 0, F.col("id") % 3).alias("y"))
    for got in (sampling.train_test_split(df, 0.2, 1, "k"), sampling.train_test_split(df, 0.2, 1, "k", stratify="y")):
        assert {r.split: r["count"] for r in got.groupBy("split").count().collect()} == {"test": 20, "train": 80}
    f = sampling.assign_folds(df, 5, "k", "stratified", 3, label="y")
    assert f.count() == 100 and f.where("fold is null").count() == 0


def test_nan_is_missing_everywhere(spark):
    df = spark.createDataFrame([(1, 1.0), (1, float("nan")), (1, 3.0), (1, None)], "g int, v double")
    fill = lambda d: sorted(r.v for r in d.collect())
    assert fill(clean.fill_stat(df, ["v"], "mean")) == [1.0, 2.0, 2.0, 3.0]
    assert fill(clean.fill_stat(df, ["v"], "median")) == [1.0, 2.0, 2.0, 3.0]
    assert fill(clean.fill_stat(df, ["v"], "mode")) == [1.0, 1.0, 1.0, 3.0]
    assert fill(clean.fill_literal(df, {"v": 0.0})) == [0.0, 0.0, 1.0, 3.0]
    assert fill(clean.fill_group_median(df, "v", "g")) == [1.0, 2.0, 2.0, 3.0]


def _rows(spark):
    return spark.range(400).select(F.col("id"), (F.col("id") % 20).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
                                   ((F.col("id") % 20) > 9).cast("int").alias("label"), ((F.col("id") % 20) * 2.0 + 1).alias("y"))


@pytest.mark.parametrize("kind", ["nb", "ada", "scaled", "enet", "poly", "avg"])
def test_own_models_save_and_load(spark, tmpdir_path, kind):
    df = encode.assemble(_rows(spark), ["a", "b"])
    if kind == "nb":
        m = bayes.GaussianNB(features=["a", "b"]).fit(df)
    elif kind == "ada":
        m = trees.AdaBoost(n_estimators=3).fit(df)
    elif kind == "scaled":
        m = encode.with_scaling(lambda d: linear.fit_logistic(d), ["a", "b"])(_rows(spark))
    elif kind == "enet":
        m = linear.fit_elastic_net(df, label="y", alpha=0.01)
    elif kind == "poly":
        m = linear.PolyRidge(cols=["a", "b"], label="y").fit(df)
    else:
        m = base.Averaging([linear.PolyRidge(cols=["a"], label="y"), linear.PolyRidge(cols=["a", "b"], label="y")]).fit(df)
    io.save_model(m, f"{tmpdir_path}/m")
    io.save_model(PipelineModel([m]), f"{tmpdir_path}/p")
    spark2 = spark.newSession()
    want = [(r.id, r.prediction) for r in m.transform(df).select("id", "prediction").orderBy("id").collect()]
    for path in ("m", "p"):
        got = io.load_model(f"{tmpdir_path}/{path}")
        assert [(r.id, r.prediction) for r in got.transform(df).select("id", "prediction").orderBy("id").collect()] == want
    assert spark2 is not None


def test_limits_are_errors_not_cuts(spark, tmpdir_path):
    with pytest.raises(ValueError, match="not a class label"):
        bayes.fit_gaussian_nb(spark.range(10_002).select("id", F.col("id").cast("double").alias("a")), ["a"], label="id")
    with pytest.raises(ValueError, match="huber"):
        trees.fit_gbt(_rows(spark), loss="huber", regression=True)
    assert io.read_results(spark, f"{tmpdir_path}/none").count() == 0
    v = encode.one_hot_vector(spark.createDataFrame([("b",), ("a",), (None,)], "c string"), "c").collect()
    assert sorted((str(r.c), r.c_onehot.toArray().tolist()) for r in v) == [("None", [0, 0]), ("a", [1, 0]), ("b", [0, 1])]


def test_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


@pytest.mark.parametrize("text", ["id,a,label\n1,5,Presence2,6,Absence3,7,Absence4,8,Presence", "1,5,Presence2,6,Absence3,7,Absence4,8,Presence\n",
                                  "id,a,label\r\n1,5,Presence\r\n2,6,Absence\r\n3,7,Absence4,8,Presence\r\n"])
def test_glued_files(spark, tmpdir_path, text):
    with open(f"{tmpdir_path}/glued.csv", "w", newline="") as f:
        f.write(text)
    got = io.read_glued(spark, f"{tmpdir_path}/glued.csv", "id long, a int, label string").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, 5, "Presence"), (2, 6, "Absence"), (3, 7, "Absence"), (4, 8, "Presence")]


def test_missing_library_is_an_error_row(spark):
    from tessera.models import search

    def missing(df):
        raise ImportError("no such library " + "x" * 300)
    df = encode.assemble(_rows(spark), ["a", "b"])
    r = {x.model: x for x in search.evaluate_models({"nb": lambda d: bayes.fit_gaussian_nb(d, ["a", "b"]), "gone": missing}, df, df).collect()}
    assert r["nb"].status == "ok" and r["gone"].status == "error" and r["gone"].error.endswith("x" * 300)


def test_split_does_not_move_the_table(spark):
    wide = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("y"), F.sha2(F.col("id").cast("string"), 256).alias("pay"))
    for split in (sampling.train_test_split(wide, 0.2, 1, "k", stratify="y"), sampling.train_test_split(wide, 0.2, 1, "k")):
        plan = split._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        # the only exchange that carries the payload is behind the filter on the torn bucket's state
        assert plan.count("Exchange hashpartitioning") == 1
        got = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
        assert got == {"test": 4000, "train": 16000}
    want = order.hash_rank(wide, "k", 1, strata=["y"], out="r").where("r <= 70").select("k")
    got = order.hash_head(wide, "k", 1, F.lit(70), strata=["y"]).where("_head").select("k")
    assert got.exceptAll(want).count() == 0 and got.count() == 210
