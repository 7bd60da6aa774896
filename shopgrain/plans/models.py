"""Churn, value, demand and segment models, trained and measured by Spark ML."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    ClusteringEvaluator,
    Evaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import Imputer, RobustScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopgrain.operators.global_order import GlobalOrder
from shopgrain.sources.scratch import settle

log = logging.getLogger(__name__)

SEED = 42
DEEPEST = 30  # the deepest tree the forest allows
ROWS_PER_PARTITION = 20_000
MOST_ROWS_PER_PARTITION = 500_000  # once every core has a partition
LENGTHS = ("maxIter", "numTrees")  # parameters that tell how many trees an ensemble has

# Parameter grids, segment features and segment names.
BOOSTED_GRID = {"maxIter": [100, 200], "maxDepth": [3, 4], "stepSize": [0.05, 0.1]}
FOREST_GRID = {"numTrees": [100, 200], "maxDepth": [DEEPEST, 10], "minInstancesPerNode": [1, 3]}
SEGMENT_FEATURES = (
    "recency_days",
    "frequency",
    "monetary",
    "avg_discount",
    "tenure_days",
    "distinct_categories",
)
SEGMENT_NAMES = (
    "High-Value",
    "Loyal",
    "At-Risk",
    "Dormant",
    "Occasional",
    "New",
    "Bargain Hunters",
    "Premium",
)


@dataclass
class Trained:
    """A model, how it did on the held-out rows, and what drove it."""

    model: PipelineModel
    metrics: dict[str, float]
    parameters: dict[str, float] = field(default_factory=dict)
    importances: list[tuple[str, float]] = field(default_factory=list)
    report: DataFrame | None = None


# -- measures ----------------------------------------------------------------


def _ratio(num, den):
    return F.coalesce(num / F.nullif(den.cast("double"), F.lit(0.0)), F.lit(0.0))


def _class_measures(tp, fp, fn) -> dict:
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return {"precision": precision, "recall": recall, "f1": _ratio(2 * tp, 2 * tp + fp + fn)}


def evaluate_classifier(scored: DataFrame, label: str, prediction: str, score: str) -> DataFrame:
    """One row: accuracy, precision, recall, f1, and the area under the ROC curve."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = scored.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(y == p).alias("right"),
    )
    # Kept at every distinct score; the curve is computed across the cluster.
    auc = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=label, metricName="areaUnderROC", numBins=0
    ).evaluate(scored.select(F.col(score).cast("double"), F.col(label).cast("double")))
    named = _class_measures(F.col("tp"), F.col("fp"), F.col("fn"))
    return counts.select(
        _ratio(F.col("right"), F.col("n")).alias("accuracy"),
        *[c.alias(n) for n, c in named.items()],
        F.lit(float(auc)).alias("roc_auc"),
    )


def classification_report(
    scored: DataFrame, label: str, prediction: str, names: Mapping[int, str] = {0: "Active", 1: "Churned"}
) -> DataFrame:
    """One row per class: precision, recall, f1, rows."""
    classes = F.explode(F.array(*[F.lit(k) for k in names]))
    y, p = F.col(label) == F.col("class"), F.col(prediction) == F.col("class")
    counts = (
        scored.groupBy(label, prediction)
        .agg(F.count(F.lit(1)).alias("n"))
        .select("*", classes.alias("class"))
        .groupBy("class")
        .agg(
            F.sum(F.when(y & p, F.col("n")).otherwise(0)).alias("tp"),
            F.sum(F.when(~y & p, F.col("n")).otherwise(0)).alias("fp"),
            F.sum(F.when(y & ~p, F.col("n")).otherwise(0)).alias("fn"),
            F.sum(F.when(y, F.col("n")).otherwise(0)).alias("support"),
        )
    )
    label_map = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    named = _class_measures(F.col("tp"), F.col("fp"), F.col("fn"))
    return counts.select(
        label_map[F.col("class")].alias("class"), *[c.alias(n) for n, c in named.items()], "support"
    )


def evaluate_regressor(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: mae, rmse, r2 and mape (percent), from one pass."""
    y, e = F.col(label).cast("double"), F.col(label).cast("double") - F.col(prediction).cast("double")
    sums = scored.agg(
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.var_pop(y).alias("spread"),
        (F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(1e-9))) * 100).alias("mape"),
    )
    return sums.select(
        "mae",
        F.sqrt("mse").alias("rmse"),
        (1 - F.col("mse") / F.nullif(F.col("spread"), F.lit(0.0))).alias("r2"),
        "mape",
    )


def residual_summary(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    e = F.col(label).cast("double") - F.col(prediction).cast("double")
    return scored.agg(F.min(e).alias("min"), F.max(e).alias("max"), F.avg(e).alias("mean"))


# -- training ----------------------------------------------------------------


def split(features: DataFrame, key: Sequence[str], test_percent: int = 20, seed: int = SEED):
    """Training and test rows by a hash of the key.

    The same rows fall on the same side whenever a lost partition is recomputed.
    """
    bucket = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(100))
    return features.where(bucket >= test_percent), features.where(bucket < test_percent)


def stratified_split(
    features: DataFrame, label: str, key: Sequence[str], one_in: int = 5, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; of each class every ``one_in``-th row, in the order of a hash of the key, is for the test."""
    mixed = features.withColumn("__mixed", F.xxhash64(F.lit(seed), *key))
    order = [F.col(label), F.col("__mixed"), *map(F.col, key)]
    numbered = GlobalOrder(mixed).row_number(order, "__n").df.drop("__mixed")
    held_out = F.col("__n") % one_in == 0
    numbered = settle(numbered, "numbered")
    return numbered.where(~held_out).drop("__n"), numbered.where(held_out).drop("__n")


def _prepared(features: DataFrame, leave_out: Sequence[str], key: Sequence[str], label: str):
    """Settled doubles: training passes over the rows many times."""
    columns = [c for c in features.columns if c not in {*leave_out, *key, label}]
    doubles = features.select(
        *key, F.col(label).cast("double").alias("label"), *[F.col(c).cast("double") for c in columns]
    )
    return settle(doubles, "features"), columns


def _stages(columns: Sequence[str], scale: bool) -> list:
    filled = [f"{c}__filled" for c in columns]
    stages = [
        Imputer(strategy="median", inputCols=list(columns), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="assembled" if scale else "features"),
    ]
    if scale:
        stages.append(
            RobustScaler(inputCol="assembled", outputCol="features", withCentering=True, withScaling=True)
        )
    return stages


def _partitions(rows: int, cores: int) -> int:
    return max(1, min(rows // ROWS_PER_PARTITION, cores), rows // MOST_ROWS_PER_PARTITION)


def _sized(df: DataFrame) -> DataFrame:
    """Cached rows in no more partitions than their number or the cores need.

    Training runs a job of two stages for every level of a tree, so tasks that
    no core is free for only add their start to each.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(_partitions(df.count(), cores)).persist()


def shortened(model, n: int):
    """The ensemble of the first ``n`` trees of a fitted one.

    Boosting goes on from the trees before, and the trees of a forest do not depend on
    each other, so this is what a shorter fit gives (of a forest: with other draws).
    """
    java, context = model._java_obj, SparkContext._active_spark_context
    trees, kind = java.trees(), type(model)
    ml = context._jvm.org.apache.spark.ml
    held = context._gateway.new_array(ml.regression.DecisionTreeRegressionModel, n)
    for i in range(n):
        held[i] = trees[i]
    if kind is RandomForestRegressionModel:
        return kind(ml.regression.RandomForestRegressionModel(java.uid(), held, java.numFeatures()))
    weights = context._gateway.new_array(context._jvm.double, n)
    for i, w in enumerate(model.treeWeights[:n]):
        weights[i] = w
    made = ml.classification.GBTClassificationModel if kind is GBTClassificationModel else ml.regression.GBTRegressionModel
    return kind(made(java.uid(), held, weights))


@dataclass
class Search:
    """The best model, and the mean measure of every point of the grid over the folds."""

    model: PipelineModel
    tried: list[tuple[dict, float]]


def grid_search(
    train: DataFrame,
    key: Sequence[str],
    stages: list,
    estimator: Estimator,
    grid: Mapping[str, Sequence],
    evaluator: Evaluator,
    folds: int,
    parallelism: int,
) -> Search:
    """All points of the grid measured on ``folds`` folds, by a hash of the key, with the work they share done once.

    Filling and scaling are fitted once for a fold. Points that differ in the number
    of trees only are one fit of the longest, measured after each number.
    """
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    prepare = Pipeline(stages=stages)

    def params(point: Mapping) -> dict:
        return {estimator.getParam(n): v for n, v in point.items()}

    if len(points) == 1:
        return Search(Pipeline(stages=[*stages, estimator]).fit(train, params(points[0])), [])
    length = next(n for n in grid if n in LENGTHS)
    rest = [dict(t) for t in dict.fromkeys(tuple((n, v) for n, v in p.items() if n != length) for p in points)]
    fold = F.pmod(F.xxhash64(F.lit(SEED + 1), *key), F.lit(folds))
    sides = []
    for i in range(folds):
        known = train.where(fold != i)
        prepared = prepare.fit(known)
        sides.append(
            [_sized(prepared.transform(df).select("label", "features")) for df in (known, train.where(fold == i))]
        )

    def measured(task: tuple[list[DataFrame], dict]) -> list[tuple[int, float]]:
        (learn, check), shared = task
        whole = estimator.fit(learn, params({**shared, length: max(grid[length])}))
        return [
            (points.index({**shared, length: n}), evaluator.evaluate(shortened(whole, n).transform(check)))
            for n in grid[length]
        ]

    tasks = [(side, shared) for side in sides for shared in rest]
    with ThreadPool(parallelism) as pool:
        found = pool.map(inheritable_thread_target(train.sparkSession)(measured), tasks, chunksize=1)
    for side in sides:
        for df in side:
            df.unpersist()
    sums = [0.0] * len(points)
    for place, value in (x for one in found for x in one):
        sums[place] += value / folds
    best = (max if evaluator.isLargerBetter() else min)(range(len(points)), key=sums.__getitem__)
    prepared = prepare.fit(train)
    learn = _sized(prepared.transform(train).select("label", "features"))
    model = estimator.fit(learn, params(points[best]))
    learn.unpersist()
    return Search(PipelineModel([*prepared.stages, model]), list(zip(points, sums)))


def _chosen(model: PipelineModel, grid: Mapping[str, Sequence]) -> dict[str, float]:
    last = model.stages[-1]
    return {name: last.getOrDefault(name) for name in grid}


def _top_importances(model: PipelineModel, columns: Sequence[str], n: int = 10):
    weights = model.stages[-1].featureImportances.toArray()
    return sorted(zip(columns, map(float, weights)), key=lambda pair: (-pair[1], pair[0]))[:n]


def train_churn(
    features: DataFrame,
    grid: Mapping[str, Sequence] = BOOSTED_GRID,
    folds: int = 3,
    keep_recency: bool = False,
    parallelism: int = 8,
) -> Trained:
    """Who has stopped buying.

    The label is a threshold on recency, so recency is left out unless asked for.
    """
    hidden = ["lifetime_value"] + ([] if keep_recency else ["recency_days"])
    data, columns = _prepared(features, hidden, ["customer_id"], "is_churned")
    train, test = stratified_split(data, "label", ["customer_id"])
    evaluator = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    model = grid_search(
        train, ["customer_id"], _stages(columns, True), GBTClassifier(seed=SEED), grid, evaluator, folds, parallelism
    ).model
    scored = model.transform(test).withColumn("score", vector_to_array("probability")[1])
    scored = settle(scored.select("label", "prediction", "score"), "scored")
    metrics = evaluate_classifier(scored, "label", "prediction", "score").first().asDict()
    report = classification_report(scored, "label", "prediction")
    return Trained(model, metrics, _chosen(model, grid), _top_importances(model, columns), report)


def _train_regressor(features, hidden, key, label, stages, estimator, grid, folds, parallelism) -> Trained:
    data, columns = _prepared(features.dropna(subset=[label]), hidden, key, label)
    train, test = split(data, key)
    evaluator = RegressionEvaluator(labelCol="label", metricName="r2")
    model = grid_search(train, key, stages(columns), estimator, grid, evaluator, folds, parallelism).model
    scored = settle(model.transform(test).select("label", "prediction"), "scored")
    metrics = evaluate_regressor(scored, "label", "prediction").first().asDict()
    report = residual_summary(scored, "label", "prediction")
    return Trained(model, metrics, _chosen(model, grid), _top_importances(model, columns), report)


def train_ltv(
    features: DataFrame,
    grid: Mapping[str, Sequence] = BOOSTED_GRID,
    folds: int = 3,
    parallelism: int = 8,
) -> Trained:
    """What a customer is worth."""
    return _train_regressor(
        features,
        ["is_churned", "monetary"],
        ["customer_id"],
        "lifetime_value",
        lambda columns: _stages(columns, True),
        GBTRegressor(seed=SEED),
        grid,
        folds,
        parallelism,
    )


def train_demand(
    features: DataFrame,
    grid: Mapping[str, Sequence] = FOREST_GRID,
    folds: int = 3,
    parallelism: int = 8,
) -> Trained:
    """How many units of a product sell in a week."""
    numbered = features.withColumns({"key_year": F.col("year"), "key_week": F.col("week")})
    return _train_regressor(
        numbered,
        [],
        ["product_id", "key_year", "key_week"],
        "units_sold",
        lambda columns: _stages(columns, False),
        # Deep trees have many open nodes a level; with more memory for them a level takes fewer passes.
        RandomForestRegressor(seed=SEED, maxMemoryInMB=1024, cacheNodeIds=True),
        grid,
        folds,
        parallelism,
    )


@dataclass
class Segments:
    """Customers with their cluster, and how good the clusters are."""

    customers: DataFrame
    k: int
    silhouette: float
    tried: dict[int, float]


def segment_customers(
    features: DataFrame, sizes: Sequence[int] = range(3, 9), columns: Sequence[str] = SEGMENT_FEATURES
) -> Segments:
    """K-means with the number of clusters that separates best, judged on all rows."""
    used = [c for c in columns if c in features.columns]
    data = settle(
        features.select("customer_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in used]),
        "features",
    )
    prepare = Pipeline(
        stages=[
            VectorAssembler(inputCols=used, outputCol="assembled"),
            RobustScaler(inputCol="assembled", outputCol="features", withCentering=True, withScaling=True),
        ]
    ).fit(data)
    scaled = prepare.transform(data).drop("assembled").persist()
    try:
        evaluator, tried, models = ClusteringEvaluator(), {}, {}
        for k in sizes:
            models[k] = KMeans(k=k, seed=SEED, initSteps=5).fit(scaled)
            tried[k] = evaluator.evaluate(models[k].transform(scaled))
        best = max(tried, key=tried.get)
        clusters = models[best].transform(scaled).withColumnRenamed("prediction", "cluster")
        settled = settle(clusters.drop("features"), "segments")
    finally:
        scaled.unpersist()
    return Segments(settled, best, tried[best], tried)


def cluster_profile(customers: DataFrame, columns: Sequence[str] = SEGMENT_FEATURES) -> DataFrame:
    """One row per cluster: size, means, and a name by its place in monetary value."""
    used = [c for c in columns if c in customers.columns]
    profile = customers.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("customers"), *[F.round(F.avg(c), 2).alias(c) for c in used]
    )
    # One row per cluster: a handful.
    place = F.row_number().over(Window.orderBy(F.desc("monetary"), "cluster"))
    names = F.array(*[F.lit(n) for n in SEGMENT_NAMES])
    other = F.concat(F.lit("Cluster-"), F.col("cluster"))
    return profile.withColumn(
        "segment_label", F.coalesce(F.try_element_at(names, place), other)
    ).orderBy(F.desc("monetary"))


def metrics_frame(spark: SparkSession, results: Mapping[str, Mapping[str, float]]) -> DataFrame:
    rows = [(m, n, float(v)) for m, values in results.items() for n, v in values.items() if v is not None]
    return spark.createDataFrame(rows, "model string, metric string, value double")


def run_ml(
    spark: SparkSession, steps: Mapping[str, Callable[[], Mapping[str, float]]]
) -> tuple[DataFrame, dict[str, str]]:
    """Every model's metrics, and the message of each model that failed."""
    done, failed = {}, {}
    for name, train in steps.items():
        try:
            done[name] = train()
        except Exception as error:
            failed[name] = str(error)
            log.warning("%s failed: %s", name, error)
    return metrics_frame(spark, done), failed


def all_models(
    customers: DataFrame,
    products: DataFrame,
    boosted: Mapping[str, Sequence] = BOOSTED_GRID,
    forest: Mapping[str, Sequence] = FOREST_GRID,
    folds: int = 3,
) -> dict[str, Callable[[], Mapping[str, float]]]:
    def segments() -> Mapping[str, float]:
        found = segment_customers(customers)
        return {"best_k": found.k, "silhouette_score": found.silhouette}

    return {
        "churn": lambda: train_churn(customers, boosted, folds).metrics,
        "ltv": lambda: train_ltv(customers, boosted, folds).metrics,
        "demand": lambda: train_demand(products, forest, folds).metrics,
        "segments": segments,
    }
