"""Tree models through ``pyspark.ml`` (L5-L7) and AdaBoost over stumps.

Parameter names follow the reference's estimators; the translation to
Spark is one place (``_tree_params``). XGBoost / LightGBM configurations
map onto Spark's gradient-boosted trees: n_estimators -> maxIter,
learning_rate -> stepSize, max_depth -> maxDepth, subsample ->
subsamplingRate, colsample -> featureSubsetStrategy, gamma -> minInfoGain,
min_child_samples -> minInstancesPerNode. Leaf-wise growth, leaf penalties,
early stopping and Huber loss are in ``boosting``.

``min_samples_split`` rewrites a fitted tree: a node with fewer rows becomes a
leaf. Splits below a node never change those above it, so the result is the
tree that would not have split the node.

Large tables of few features are counted per cell of their bins first, and
Spark's learners fit the cells with their row counts as weights (see ``cells``;
the model bins raw features itself). A forest's trees are then fitted one by
one, each on its own Poisson draws of the cells' rows. What weights cannot say
(subsampling of rows in boosting, absolute loss, ``min_samples_leaf`` above
``LEAST``, a weight column) is fitted row by row.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark import SparkContext, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, spread
from . import cells
from .base import FitEstimator, StateModel
from .linear import balanced_weights

MAX_DEPTH = 30  # Spark's limit; stands in for "no depth limit"
#: a cell stands for its rows in up to as many parts, so that a leaf's rows are counted right
LEAST = 32
#: trees of a forest fitted at once on cells
AT_ONCE = 4


def _tree_params(max_depth=None, min_samples_leaf=1, seed=42, max_bins=32, **extra):
    p = {"maxDepth": MAX_DEPTH if max_depth is None else int(max_depth),
         "minInstancesPerNode": int(min_samples_leaf), "seed": seed, "maxBins": max_bins}
    p.update({k: v for k, v in extra.items() if v is not None})
    return p


def _collapsed(jvm, node, least: int, weighed: bool = False):
    """The node with every descendant of fewer than ``least`` rows turned into a leaf (a JVM node); ``weighed``: its weights are numbers of rows."""
    stats = node.impurityStats()
    if node.getClass().getSimpleName() == "LeafNode":
        return node
    if (round(stats.count()) if weighed else stats.rawCount()) < least:
        return jvm.org.apache.spark.ml.tree.LeafNode(node.prediction(), node.impurity(), stats)
    left, right = (_collapsed(jvm, child, least, weighed) for child in (node.leftChild(), node.rightChild()))
    return jvm.org.apache.spark.ml.tree.InternalNode(node.prediction(), node.impurity(), node.gain(), left, right, node.split(), stats)


def _java_model(jvm, cls: str, args):
    """A JVM model of the class named ``cls``."""
    made = getattr(getattr(jvm.org.apache.spark.ml, "classification" if "Classification" in cls else "regression"), cls.split(".")[-1])
    return made(*args)


def _java_trees(sc, trees: list):
    kind = trees[0].getClass().getName()
    out = sc._gateway.new_array(getattr(getattr(sc._jvm.org.apache.spark.ml, kind.split(".")[-2]), kind.split(".")[-1]), len(trees))
    for i, t in enumerate(trees):
        out[i] = t
    return out


def collapse(model, min_samples_split: int, weighed: bool = False):
    """A fitted tree or forest whose nodes of fewer than ``min_samples_split`` rows are leaves.

    Rows are counted as the fit saw them (in a forest: in each tree's own
    sample). The result is a model of the same class, saved and loaded like any.
    """
    sc, j = SparkContext._active_spark_context, model._java_obj
    jvm = sc._jvm
    name = j.getClass().getName()

    def rebuilt(tree):
        root = _collapsed(jvm, tree.rootNode(), int(min_samples_split), weighed)
        args = [tree.uid(), root, tree.numFeatures()]
        return args + ([tree.numClasses()] if "Classification" in tree.getClass().getName() else [])

    if "RandomForest" in name:
        trees = _java_trees(sc, [_java_model(jvm, t.getClass().getName(), rebuilt(t)) for t in j.trees()])
        args = [j.uid(), trees, j.numFeatures()] + ([j.numClasses()] if "Classification" in name else [])
        new = _java_model(jvm, name, args)
    else:
        new = _java_model(jvm, name, rebuilt(j))
    j.copyValues(new, j.extractParamMap())
    return type(model)(new)


def _min_rows(min_samples_split, df: DataFrame) -> int:
    """A share of the rows (a float) as a number."""
    return math.ceil(min_samples_split * df.count()) if isinstance(min_samples_split, float) else int(min_samples_split)


def _split_rows(min_samples_split, c: cells.Cells) -> int:
    return math.ceil(min_samples_split * c.rows) if isinstance(min_samples_split, float) else int(min_samples_split)


def _classed(df: DataFrame, label: str) -> DataFrame:
    """The label with its number of classes noted, so that a draw without the last class has as many."""
    k = int(df.agg(F.max(label)).first()[0]) + 1
    return df.withColumn(label, F.col(label).cast("double").alias(label, metadata={"ml_attr": {"type": "nominal", "num_vals": k}}))


def fit_tree(df: DataFrame, features="features", label="label", max_depth=None, min_samples_leaf=1, seed=42,
             weight_col=None, min_samples_split=2):
    """Decision tree; ``min_samples_split`` rows (or share of the rows) at least are split."""
    c = cells.of(df, features, label) if weight_col is None and min_samples_leaf <= LEAST else None
    if c is not None:
        est = DecisionTreeClassifier(featuresCol=cells.BINS, labelCol=label, weightCol=cells.ROWS, **_tree_params(max_depth, min_samples_leaf, seed))
        model, least = est.fit(cells.repeated(c.frame, min_samples_leaf)), _split_rows(min_samples_split, c)
        return c.model(collapse(model, least, weighed=True) if least > 2 else model)
    est = DecisionTreeClassifier(featuresCol=features, labelCol=label, **_tree_params(max_depth, min_samples_leaf, seed),
                                 **({"weightCol": weight_col} if weight_col else {}))
    model, least = est.fit(df), _min_rows(min_samples_split, df)
    return collapse(model, least) if least > 2 else model


def fit_forest(df: DataFrame, features="features", label="label", n_estimators=100, max_depth=None,
               min_samples_leaf=1, balanced=False, seed=42, regression=False, max_features="auto", min_samples_split=2):
    """Random forest classifier / regressor."""
    countable = min_samples_leaf <= LEAST and (not balanced or regression or min_samples_split == 2)
    c = cells.of(df, features, label, regression) if countable else None
    if c is not None:
        return c.model(_forest_of_cells(c, label, int(n_estimators), balanced and not regression, regression, str(max_features), min_samples_split,
                                        max_depth, min_samples_leaf, seed))
    weight = None
    if balanced and not regression:
        df, weight = balanced_weights(df, label), "weight"
    cls = RandomForestRegressor if regression else RandomForestClassifier
    est = cls(featuresCol=features, labelCol=label, numTrees=int(n_estimators),
              featureSubsetStrategy=str(max_features),
              **_tree_params(max_depth, min_samples_leaf, seed), **({"weightCol": weight} if weight else {}))
    rows = spread(df.select(features, label, *([weight] if weight else [])))
    model, least = est.fit(rows), _min_rows(min_samples_split, rows)
    return collapse(model, least) if least > 2 else model


def _forest_of_cells(c: cells.Cells, label: str, n: int, balanced: bool, regression: bool, max_features: str, min_samples_split,
                     max_depth, min_samples_leaf, seed):
    """A forest of single trees, each on its own draws of the cells' rows."""
    frame, share = c.frame, F.lit(1.0)
    if not regression:
        frame = _classed(frame, label)
    if balanced:
        counts = {r[0]: r[1] for r in frame.groupBy(label).agg(F.sum(cells.ROWS)).collect()}
        frame, share = balanced_weights(frame, label, "_share", counts), None
        shares = {r[0]: r[1] for r in frame.select(label, "_share").distinct().collect()}
        frame = frame.drop("_share")
        for v, s in shares.items():
            share = F.when(F.col(label) == v, F.lit(s)) if share is None else share.when(F.col(label) == v, F.lit(s))
    drawn = cells.bagged(frame, label, n, seed)
    if not regression:
        drawn = drawn.withColumn(label, F.col(label).alias(label, metadata=frame.schema[label].metadata))
    if max_features == "auto" and n > 1:
        max_features = "onethird" if regression else "sqrt"
    cls = RandomForestRegressor if regression else RandomForestClassifier

    def one(t):
        rows = drawn.withColumn(cells.ROWS, F.col("_bag")[t]).where(F.col(cells.ROWS) > 0)
        rows = cells.repeated(rows, min_samples_leaf).withColumn(cells.ROWS, F.col(cells.ROWS) * share)
        est = cls(featuresCol=cells.BINS, labelCol=label, weightCol=cells.ROWS, numTrees=1, bootstrap=False, featureSubsetStrategy=max_features,
                  **_tree_params(max_depth, min_samples_leaf, seed + t))
        return est.fit(rows.select(cells.BINS, label, cells.ROWS))
    with ThreadPoolExecutor(AT_ONCE) as ex:
        models = list(ex.map(one, range(n)))
    sc, j = SparkContext._active_spark_context, models[0]._java_obj
    trees = _java_trees(sc, [m._java_obj.trees()[0] for m in models])
    new = _java_model(sc._jvm, j.getClass().getName(), [j.uid(), trees, j.numFeatures()] + ([] if regression else [j.numClasses()]))
    j.copyValues(new, j.extractParamMap())
    new.set(new.getParam("numTrees"), n)
    new.set(new.getParam("bootstrap"), True)
    model = type(models[0])(new)
    least = _split_rows(min_samples_split, c)
    return collapse(model, least, weighed=True) if least > 2 else model


def fit_gbt(df: DataFrame, features="features", label="label", n_estimators=100, learning_rate=0.1, max_depth=3,
            subsample=1.0, colsample=None, gamma=None, min_samples_leaf=1, regression=False, loss=None, seed=42,
            max_bins=32):
    """Gradient-boosted trees (also the re-aimed XGBoost / LightGBM
    configurations). Regression losses: squared / absolute."""
    cls = GBTRegressor if regression else GBTClassifier
    extra = {"featureSubsetStrategy": str(colsample) if colsample is not None else None,
             "minInfoGain": gamma}
    params = _tree_params(max_depth, min_samples_leaf, seed, max_bins, **extra)
    if loss:
        if loss not in ("squared", "absolute", "logistic"):
            raise ValueError(f"loss {loss!r}: squared, absolute or logistic here; Huber loss is in boosting.fit_boosting")
        params["lossType"] = loss
    est = cls(featuresCol=features, labelCol=label, maxIter=int(n_estimators), stepSize=float(learning_rate),
              subsamplingRate=float(subsample), **params)
    c = cells.of(df, features, label, regression, max_bins) if subsample >= 1 and loss != "absolute" and min_samples_leaf <= LEAST else None
    if c is not None:
        est = est.copy({est.featuresCol: cells.BINS, est.weightCol: cells.ROWS})
        return c.model(est.fit(cells.repeated(c.frame, min_samples_leaf).select(cells.BINS, label, cells.ROWS)))
    return est.fit(spread(df.select(features, label)))


class AdaBoostModel(StateModel):
    """SAMME over stumps: decision = sum a_m h_m / sum a_m with h in {-1, 1};
    probability of class 1 = sigmoid(decision) as for a binary SAMME model."""

    def __init__(self, stumps=(), alphas=None, prediction="prediction", probability="probability"):
        super().__init__(None if alphas is None else {"alphas": alphas, "prediction": prediction, "probability": probability}, stumps)

    @property
    def stumps(self):
        return self.parts

    @property
    def alphas(self):
        return self.learned["alphas"]

    def _transform(self, df: DataFrame) -> DataFrame:
        a = self.learned
        total = sum(a["alphas"]) or 1.0
        out, terms = df, []
        for i, (m, w) in enumerate(zip(self.parts, a["alphas"])):
            m = m.copy({m.predictionCol: f"_h{i}", m.rawPredictionCol: f"_raw{i}", m.probabilityCol: f"_pr{i}"})
            out = m.transform(out).drop(f"_raw{i}", f"_pr{i}")
            terms.append(F.lit(w / total) * (2 * F.col(f"_h{i}") - 1))
        dec = terms[0]
        for t in terms[1:]:
            dec = dec + t
        out = out.withColumn("decision", dec)
        out = out.withColumn(a["probability"], 1.0 / (1.0 + F.exp(-F.col("decision"))))
        out = out.withColumn(a["prediction"], (F.col("decision") > 0).cast("double"))
        return out.drop(*[f"_h{i}" for i in range(len(self.parts))])


def fit_adaboost(df: DataFrame, features="features", label="label", n_estimators=50, learning_rate=1.0,
                 max_depth=1, seed=42, checkpoint_every=10) -> AdaBoostModel:
    """Discrete AdaBoost (SAMME, two classes). Each round fits a
    weighted stump, measures its weighted error in one aggregate, and
    re-weights rows with a projection; lineage is cut with a reliable
    checkpoint every ``checkpoint_every`` rounds."""
    c = cells.of(df, features, label)
    if c is not None:
        df, features = c.frame, cells.BINS
    cur = df.select(features, label, (F.lit(1.0) if c is None else F.col(cells.ROWS)).alias("_w"))
    stumps, alphas = [], []
    for m in range(int(n_estimators)):
        est = DecisionTreeClassifier(featuresCol=features, labelCol=label, weightCol="_w", maxDepth=max_depth,
                                     seed=seed + m, predictionCol="_hp", rawPredictionCol="_hr",
                                     probabilityCol="_hq")
        stump = est.fit(cur)
        scored = stump.transform(cur).withColumn("_miss", (F.col("_hp") != F.col(label)).cast("double"))
        st = scored.agg((F.sum(F.col("_w") * F.col("_miss")) / F.sum("_w")).alias("e"),
                        F.avg("_w").alias("s")).first()
        err = st["e"]
        if err is None or err >= 0.5:
            if not stumps:
                stumps.append(stump)
                alphas.append(1.0)
            break
        if err <= 0:
            stumps.append(stump)
            alphas.append(1.0)
            break
        alpha = learning_rate * math.log((1 - err) / err)
        stumps.append(stump)
        alphas.append(alpha)
        # re-weight and renormalise to mean 1 (keeps weights finite over many rounds)
        prev = cur
        cur = scored.withColumn("_w", F.col("_w") * F.exp(F.lit(alpha) * F.col("_miss")) / F.lit(st["s"])) \
            .select(features, label, "_w")
        if (m + 1) % checkpoint_every == 0:
            cur = cut_lineage(cur)
        else:
            cur = cur.persist(StorageLevel.MEMORY_AND_DISK)
        prev.unpersist()
    model = AdaBoostModel(stumps, alphas)
    return model if c is None else c.model(model)


class RealAdaBoostModel(StateModel):
    """SAMME.R: class log-probabilities of the parts, centred over the classes, averaged.

    ``probability`` is that of class 1 for two classes; ``prediction`` the class of the largest sum, ties to the smaller class.
    """

    def __init__(self, parts=(), n_classes: int | None = None):
        super().__init__(None if n_classes is None else {"n_classes": n_classes}, parts)

    def _transform(self, df: DataFrame) -> DataFrame:
        k, names = self.learned["n_classes"], []
        out = df
        for i, m in enumerate(self.parts):
            m = m.copy({m.predictionCol: f"_h{i}", m.rawPredictionCol: f"_raw{i}", m.probabilityCol: f"_pr{i}"})
            out = m.transform(out).withColumn(f"_lp{i}", log_probabilities(f"_pr{i}")).drop(f"_h{i}", f"_raw{i}", f"_pr{i}")
            names.append(f"_lp{i}")
        total = [sum((F.col(n)[c] for n in names[1:]), F.col(names[0])[c]) for c in range(k)]
        mean = sum(total[1:], total[0]) / k
        decision = F.array(*[(k - 1) * (t - mean) for t in total])
        out = out.withColumn("_d", decision).drop(*names)
        out = out.withColumn("prediction", (F.array_position("_d", F.array_max("_d")) - 1).cast("double"))
        e = [F.exp(F.col("_d")[c] / F.lit((k - 1) * len(self.parts))) for c in range(k)]
        if k == 2:
            out = out.withColumn("decision", F.col("_d")[1]).withColumn("probability", e[1] / (e[0] + e[1]))
        return out.drop("_d")


def log_probabilities(col: str):
    """Logarithms of a probability vector's entries, no entry below the smallest positive step of 1."""
    return F.transform(vector_to_array(col), lambda p: F.log(F.greatest(p, F.lit(EPS))))


#: smallest probability (the distance of 1 to the next double)
EPS = 2.0 ** -52


def fit_adaboost_real(df: DataFrame, features="features", label="label", n_estimators=50, learning_rate=1.0, max_depth=1, seed=42,
                      n_classes: int | None = None, checkpoint_every=5) -> RealAdaBoostModel:
    """SAMME.R. Each round fits a weighted tree and multiplies a row's weight by
    exp(-rate (K - 1) / K sum_k code_k log p_k), code 1 for its class and -1 / (K - 1) for the others; weights are kept
    as logarithms, shifted by their maximum (one aggregate a round). A round without errors ends the fit.
    """
    c = cells.of(df, features, label)
    if c is not None:
        df, features, checkpoint_every = c.frame, cells.BINS, 1     # cells are soon written
    k = n_classes or int(df.agg(F.max(label)).first()[0]) + 1
    cur = df.select(features, F.col(label).cast("double").alias(label), (F.lit(0.0) if c is None else F.log(cells.ROWS)).alias("_lw"))
    parts = []
    for m in range(int(n_estimators)):
        weighed = cur.withColumn("_w", F.exp("_lw"))
        est = DecisionTreeClassifier(featuresCol=features, labelCol=label, weightCol="_w", maxDepth=max_depth, seed=seed + m,
                                     predictionCol="_hp", rawPredictionCol="_hr", probabilityCol="_hq")
        part = est.fit(weighed)
        if part.numClasses < k:
            raise ValueError(f"labels below {k} must all occur")
        parts.append(part)
        lp = log_probabilities("_hq")
        own = F.element_at(lp, (F.col(label) + 1).cast("int"))
        code = own - (F.aggregate(lp, F.lit(0.0), lambda a, b: a + b) - own) / (k - 1)
        moved = part.transform(weighed).withColumn("_lw", F.col("_lw") - learning_rate * (k - 1) / k * code)
        st = moved.agg(F.max("_lw").alias("top"), F.max((F.col("_hp") != F.col(label)).cast("int")).alias("miss")).first()
        if not st["miss"]:
            break
        cur = moved.select(features, label, (F.col("_lw") - F.lit(st["top"])).alias("_lw"))
        if (m + 1) % checkpoint_every == 0:
            cur = cut_lineage(cur)
    model = RealAdaBoostModel(parts, k)
    return model if c is None else c.model(model)


class AdaBoost(FitEstimator):
    """``AdaBoost(n_estimators=..., learning_rate=..., max_depth=..., algorithm='SAMME' | 'SAMME.R')`` as an ``ml`` estimator."""

    def _fit(self, df: DataFrame):
        options = self.options
        fit = {"SAMME": fit_adaboost, "SAMME.R": fit_adaboost_real}[options.pop("algorithm", "SAMME")]
        return fit(df, **options)
