"""Champion and challenger training on pyspark.ml (M1-M7).

Training rows are assembled into one vector column and persisted once for all
fits of a search. Scores come back as a long table keyed by applicant, never by
row position.
"""

from __future__ import annotations

import math
import random
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import SparkContext, StorageLevel, inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.operators import metrics as M
from lendframe.operators.splits import stratified_split
from lendframe.session import ensure_checkpoint_dir

KEY, TARGET = "SK_ID_CURR", "TARGET"
# The champion grid and the limits of the smoke verdict.
C_GRID = (0.0001, 0.001, 0.01, 0.1, 1.0)
L1_GRID = (0.0, 0.5, 1.0)
TRIALS = 30
MAX_ROUNDS = 2000
PATIENCE = 50
PARALLEL_TRIALS = 4
SEED = 42
AUC_LEAK, AUC_HIGH, AUC_LOW, OVERFIT_GAP = 0.85, 0.82, 0.75, 0.05
MISSING_VALUE = -1.0e9


def feature_columns(df: DataFrame, key: str = KEY, target: str = TARGET) -> list[str]:
    return [c for c in df.columns if c not in (key, target, "split")]


def vectors(df: DataFrame, features: Sequence[str], key: str = KEY, target: str = TARGET, extra: Sequence[str] = ()) -> DataFrame:
    """(key, features, label): nulls become a value below every real one, so trees can split them off."""
    filled = df.select(
        key,
        *extra,
        F.col(target).cast("double").alias("label"),
        *[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(MISSING_VALUE)).alias(f) for f in features],
    )
    out = VectorAssembler(inputCols=list(features), outputCol="features").transform(filled)
    return out.select(key, *extra, "label", "features")


def held(df: DataFrame) -> DataFrame:
    """Persisted and filled, in the partitions it is made in."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    return kept


def few(kept: DataFrame) -> DataFrame:
    """A held table read in a number of partitions that the cluster sets and not the table: every pass of a fit sends the driver one result a partition."""
    return kept.coalesce(2 * kept.sparkSession.sparkContext.defaultParallelism)


def probability(column: str = "probability") -> Column:
    """Event probability clipped to [0, 1] (M5)."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), vector_to_array(F.col(column))[1]))


def validation_auc(scored: DataFrame) -> float:
    """AUC over every distinct score, by the evaluator of pyspark.ml: one small job per fit of a search."""
    return BinaryClassificationEvaluator(rawPredictionCol="pd", labelCol="label", numBins=0).evaluate(scored)


@dataclass
class Search:
    """Result of a search: the model, its parameters, and one row per fit."""

    model: object
    params: dict
    trials: DataFrame
    features: list[str]


def fit_logistic(train: DataFrame, rows: int, c: float, l1_ratio: float, max_iter: int = 200) -> LogisticRegressionModel:
    """Elastic-net logistic regression without class weights (M1); the penalty is 1 / (C n)."""
    return LogisticRegression(
        regParam=1.0 / (c * rows), elasticNetParam=l1_ratio, standardization=False, maxIter=max_iter, tol=1e-6
    ).fit(train)


def champion_search(
    train: DataFrame,
    val: DataFrame,
    c_grid: Sequence[float] = C_GRID,
    l1_grid: Sequence[float] = L1_GRID,
    key: str = KEY,
    target: str = TARGET,
    max_iter: int = 200,
) -> Search:
    """Grid search by validation AUC; the first of equal fits wins (M2). Each trial records whether its solver converged."""
    features = feature_columns(train, key, target)
    x = held(vectors(train, features, key, target))
    v = held(vectors(val, features, key, target))
    rows = x.count()
    log, best = [], None
    try:
        for c in c_grid:
            for l1 in l1_grid:
                model = fit_logistic(few(x), rows, c, l1, max_iter)
                auc = validation_auc(model.transform(few(v)).select("label", probability().alias("pd")))
                rounds = int(model.summary.totalIterations)
                log.append((c, l1, auc, 2 * auc - 1, int(sum(1 for b in model.coefficients.toArray() if b != 0)), rounds, rounds < max_iter))
                if best is None or auc > best[0]:
                    best = (auc, model, {"C": c, "l1_ratio": l1})
    finally:
        x.unpersist()
        v.unpersist()
    trials = train.sparkSession.createDataFrame(log, "C double, l1_ratio double, val_auc double, val_gini double, n_nonzero int, iterations int, converged boolean")
    return Search(best[1], best[2], trials, features)


def sample_params(seed: int, trial: int) -> dict:
    """One draw from the search space (M4): learning rate and the least gain of a split, which takes the place of penalties, on a log scale."""
    rng = random.Random(f"{seed}-{trial}")
    return {
        "stepSize": math.exp(rng.uniform(math.log(0.01), math.log(0.10))),
        "maxDepth": rng.randint(3, 12),
        "minInstancesPerNode": rng.randrange(10, 201, 10),
        "subsamplingRate": rng.uniform(0.6, 1.0),
        "featureSubsetStrategy": f"{rng.uniform(0.5, 1.0):.4f}",
        "minInfoGain": math.exp(rng.uniform(math.log(1e-8), math.log(1e-3))),
    }


def fit_trees(train: DataFrame, params: Mapping, rounds: int, seed: int = SEED) -> GBTClassificationModel:
    """Boosted trees (M3). Labels of a round are checkpointed every few rounds, so their lineage stays short."""
    ensure_checkpoint_dir(train.sparkSession)
    return GBTClassifier(maxIter=rounds, seed=seed, maxBins=64, checkpointInterval=10, **params).fit(train)


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the lowest loss seen before `patience` rounds passed without a lower one, and whether they did pass."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def first_trees(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model as it was after so many rounds: boosting only ever adds trees."""
    context = SparkContext._active_spark_context
    java, jvm = model._java_obj, context._jvm
    trees = context._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = context._gateway.new_array(jvm.double, rounds)
    every = java.trees()
    for i, w in enumerate(list(java.treeWeights())[:rounds]):
        trees[i], weights[i] = every[i], w
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), java.numClasses())
    out = GBTClassificationModel(java.copyValues(cut, java.extractParamMap()))
    out._resetUid(model.uid)
    out._transfer_params_from_java()
    return out


def boosted(train: DataFrame, held: DataFrame, params: Mapping, max_rounds: int, patience: int, seed: int = SEED, first: int = 64) -> GBTClassificationModel:
    """Boosting that stops `patience` rounds after the lowest loss on the held rows, cut back to that round.

    The loss of all rounds of a fit is one pass. Rounds double until the patience is spent, and a longer fit repeats the
    trees of a shorter one, so at most twice the rounds that are looked at are fitted.
    """
    rounds = min(max_rounds, max(first, patience + 1))
    while True:
        model = fit_trees(train, params, rounds, seed)
        best, spent = best_round(model.evaluateEachIteration(held), patience)
        if spent or rounds >= max_rounds:
            return first_trees(model, best)
        rounds = min(max_rounds, 2 * rounds)


def challenger_search(
    train: DataFrame,
    val: DataFrame,
    trials: int = TRIALS,
    max_rounds: int = MAX_ROUNDS,
    seed: int = SEED,
    key: str = KEY,
    target: str = TARGET,
    space=sample_params,
    patience: int = PATIENCE,
    parallel: int = PARALLEL_TRIALS,
) -> Search:
    """Seeded random search with early stopping (M4), the best by validation AUC, the first of equal ones.

    Trials don't depend on each other: `parallel` of them share the cluster. The chosen model is the one that was fitted on train, cut at its
    best round, which a refit with that many rounds would repeat.
    """
    features = feature_columns(train, key, target)
    x = held(vectors(train, features, key, target))
    v = held(vectors(val, features, key, target))

    def run(t: int) -> tuple:
        params = space(seed, t)
        model = boosted(few(x), few(v), params, max_rounds, patience, seed)
        auc = validation_auc(model.transform(few(v)).select("label", probability().alias("pd")))
        return t, auc, model, params

    try:
        with ThreadPoolExecutor(parallel) as pool:
            done = [f.result() for f in [pool.submit(inheritable_thread_target(train.sparkSession)(run), t) for t in range(trials)]]
    finally:
        x.unpersist()
        v.unpersist()
    log = [(t, auc, model.getNumTrees, str(params)) for t, auc, model, params in done]
    _, _, model, params = max(done, key=lambda d: (d[1], -d[0]))
    table = train.sparkSession.createDataFrame(log, "trial int, val_auc double, rounds int, params string")
    return Search(model, {**params, "rounds": model.getNumTrees}, table, features)


def score(model, df: DataFrame, features: Sequence[str], name: str, key: str = KEY, target: str = TARGET, split: str = "split") -> DataFrame:
    """(model, split, key, label, raw_pd) of every row (M5)."""
    out = model.transform(vectors(df, features, key, target, [split]))
    return out.select(F.lit(name).alias("model"), split, key, F.col("label").cast("int").alias(target), probability().alias("raw_pd"))


def split_counts(model: GBTClassificationModel) -> dict[int, int]:
    """Splits per feature number, from the table of tree nodes that a saved model consists of."""
    spark = SparkSession.getActiveSession()
    path = f"{ensure_checkpoint_dir(spark)}/trees-{uuid.uuid4().hex}"
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data").select("nodeData.leftChild", F.col("nodeData.split.featureIndex").alias("feature"))
    return {r["feature"]: r["count"] for r in nodes.where("leftChild >= 0").groupBy("feature").count().collect()}


def tree_importance(search: Search, n: int | None = None) -> DataFrame:
    """Gain and number of splits per feature, largest gain first (M6)."""
    gains, splits = search.model.featureImportances.toArray().tolist(), split_counts(search.model)
    rows = [(f, g, splits.get(i, 0)) for i, (f, g) in enumerate(zip(search.features, gains))]
    out = search.trials.sparkSession.createDataFrame(rows, "feature string, gain double, splits bigint")
    out = out.orderBy(F.col("gain").desc(), "feature")
    return out.limit(n) if n else out


def coefficient_weights(search: Search) -> dict[str, float]:
    """Every feature's coefficient, zeros included: what scoring and explaining use."""
    return dict(zip(search.features, search.model.coefficients.toArray().tolist()))


def coefficient_importance(search: Search, n: int = 20) -> DataFrame:
    """Largest coefficients by absolute value, for display (M6); `coefficient_weights` has all of them."""
    weights = search.model.coefficients.toArray().tolist()
    out = search.trials.sparkSession.createDataFrame(list(zip(search.features, weights)), "feature string, coefficient double")
    return out.withColumn("abs_coefficient", F.abs("coefficient")).orderBy(F.col("abs_coefficient").desc(), "feature").limit(n)


def smoke_verdict(metrics: DataFrame, train: str = "train", test: str = "test") -> DataFrame:
    """Verdict on a baseline model from its train and test AUC rows (M7)."""

    def of(name: str) -> Column:
        return F.max(F.when(F.col("split") == name, F.col("auc")))

    row = metrics.agg(of(train).alias("train_auc"), of(test).alias("test_auc"))
    verdict = (
        F.when(F.col("test_auc") > AUC_LEAK, "possible_leakage")
        .when(F.col("test_auc") < AUC_LOW, "below_expected")
        .when(F.col("test_auc") > AUC_HIGH, "above_expected")
        .otherwise("ok")
    )
    gap = F.col("train_auc") - F.col("test_auc")
    return row.withColumns({"gap": gap, "verdict": verdict, "overfit": gap > OVERFIT_GAP})


def smoke_model(df: DataFrame, key: str = KEY, target: str = TARGET, trees: int = 400, max_depth: int = 5, seed: int = SEED) -> DataFrame:
    """Fixed-setting baseline on an 80/20 hash split, with its verdict (M7)."""
    features = feature_columns(df, key, target)
    parts = stratified_split(df, key, target, {"dev": 0.8, "val": 0.0, "test": 0.2}, seed)
    tagged = df.join(parts, key).replace("dev", "train", "split")
    x = held(vectors(tagged, features, key, target, ["split"]))
    try:
        model = fit_trees(few(x).where("split = 'train'"), {"maxDepth": max_depth, "stepSize": 0.05}, trees, seed)
        scored = model.transform(few(x)).select("split", "label", probability().alias("pd"))
        auc = M.discrimination(scored, ["split"], "pd", "label").select("split", "auc").collect()
    finally:
        x.unpersist()
    return smoke_verdict(df.sparkSession.createDataFrame(auc, "split string, auc double"))
