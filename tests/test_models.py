"""Models learn more than a guess, and their measures are right."""

import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from shopgrain.plans import models
from shopgrain.plans.features import customer_features, product_features
from shopgrain.plans.model_queries import SMALL_BOOSTED, SMALL_FOREST
from shopgrain.plans.registry import AS_OF, CATEGORIES
from shopgrain.sources.retail import from_star_schema
from shopgrain.sources.scratch import settle

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def customers(spark):
    return settle(customer_features(from_star_schema(spark, FOLDER), AS_OF, CATEGORIES))


def test_measures(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.2), (0, 1, 0.6)], "y int, p int, s double")
    r = models.evaluate_classifier(df, "y", "p", "s").first()
    assert (r.accuracy, r.precision, r.recall, r.f1, r.roc_auc) == (0.5, 0.5, 0.5, 0.5, 0.75)
    none = models.evaluate_classifier(df.withColumn("p", df.p * 0), "y", "p", "s").first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)
    v = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, p double")
    m = models.evaluate_regressor(v, "y", "p").first()
    assert m.mae == pytest.approx(2 / 3) and m.rmse == pytest.approx(math.sqrt(2 / 3))
    assert m.r2 == pytest.approx(0.75) and m.mape == pytest.approx(40.0)


def test_split_is_stable(spark, customers):
    train, test = models.split(customers, ["customer_id"])
    assert train.count() + test.count() == customers.count()
    again = models.split(customers.repartition(13), ["customer_id"])[1]
    assert {r.customer_id for r in test.collect()} == {r.customer_id for r in again.collect()}
    assert 0.15 < test.count() / customers.count() < 0.25


def test_classes_are_cut_alike(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    train, test = models.stratified_split(df, "y", ["k"])
    assert {(r.y, r["count"]) for r in test.groupBy("y").count().collect()} == {(0, 180), (1, 20)}
    again = models.stratified_split(df.repartition(7), "y", ["k"])[1]
    assert {r.k for r in test.collect()} == {r.k for r in again.collect()}
    assert train.count() == 800


def test_churn(customers):
    trained = models.train_churn(customers, SMALL_BOOSTED)
    assert 0.5 < trained.metrics["roc_auc"] <= 1 and len(trained.importances) == 10
    assert "recency_days" not in dict(trained.importances)
    assert {r["class"] for r in trained.report.collect()} == {"Active", "Churned"}
    # With recency among the features the label leaks, as its definition says.
    assert models.train_churn(customers, SMALL_BOOSTED, keep_recency=True).metrics["roc_auc"] > 0.99


def test_value_with_a_grid(customers):
    grid = {"maxIter": [3, 10], "maxDepth": [3], "stepSize": [0.1]}
    trained = models.train_ltv(customers, grid, folds=2)
    assert trained.metrics["r2"] > 0.5 and trained.parameters["maxIter"] in (3, 10)
    assert "monetary" not in dict(trained.importances)


@pytest.mark.parametrize("kind", ["classifier", "regressor"])
def test_the_shared_search_picks_what_a_plain_one_picks(customers, kind):
    """Against a cross validation that fits everything anew for every point, on the same folds."""
    key, hidden = ["customer_id"], ["recency_days"]
    if kind == "classifier":
        data, columns = models._prepared(customers, [*hidden, "lifetime_value"], key, "is_churned")
        estimator = GBTClassifier(seed=models.SEED)
        evaluator = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    else:
        data, columns = models._prepared(customers, [*hidden, "is_churned", "monetary"], key, "lifetime_value")
        estimator, evaluator = GBTRegressor(seed=models.SEED), RegressionEvaluator(labelCol="label", metricName="r2")
    grid = {"maxIter": [2, 6], "maxDepth": [2, 3], "stepSize": [0.1, 0.4]}
    found = models.grid_search(data, key, models._stages(columns, True), estimator, grid, evaluator, 3, 4)
    points = [p for p, _ in found.tried]
    assert len(points) == 8
    plain = CrossValidator(
        estimator=Pipeline(stages=[*models._stages(columns, True), estimator]),
        estimatorParamMaps=[{estimator.getParam(n): v for n, v in p.items()} for p in points],
        evaluator=evaluator,
        numFolds=3,
        foldCol="fold",
        parallelism=4,
    ).fit(
        data.withColumn("fold", F.pmod(F.xxhash64(F.lit(models.SEED + 1), *key), F.lit(3)).cast("int"))
    )
    assert [v for _, v in found.tried] == pytest.approx(plain.avgMetrics, abs=1e-6)
    best = points[max(range(8), key=lambda i: plain.avgMetrics[i])]
    assert models._chosen(found.model, grid) == best


def test_a_forest_is_measured_by_its_first_trees(spark):
    df = spark.range(400).select(
        F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("x"), ((F.col("id") % 7) * 3.0).alias("label")
    )
    grid = {"numTrees": [2, 5], "maxDepth": [1, 4], "minInstancesPerNode": [1]}
    evaluator = RegressionEvaluator(labelCol="label", metricName="r2")
    found = models.grid_search(
        df, ["k"], models._stages(["x"], False), RandomForestRegressor(seed=1), grid, evaluator, 2, 2
    )
    by_point = {tuple(p.values()): v for p, v in found.tried}
    assert by_point[(5, 4, 1)] > by_point[(5, 1, 1)] and len(by_point) == 4
    assert found.model.stages[-1].getOrDefault("maxDepth") == 4


def test_registered_grids_end(spark):
    """The full grid of the boosted models, on the smallest table."""
    features = customer_features(from_star_schema(spark, "/root/testdata/sf0.001"), AS_OF, CATEGORIES)
    trained = models.train_ltv(features, folds=3)
    assert trained.parameters["maxIter"] in (100, 200) and trained.metrics["r2"] > 0


def test_demand(spark):
    products = product_features(from_star_schema(spark, "/root/testdata/sf0.001"), CATEGORIES)
    trained = models.train_demand(products, SMALL_FOREST)
    assert all(math.isfinite(v) for v in trained.metrics.values())


def test_segments(customers):
    found = models.segment_customers(customers, sizes=(3, 4))
    assert found.k in (3, 4) and found.silhouette == max(found.tried.values())
    profile = models.cluster_profile(found.customers).collect()
    assert len(profile) == found.k and profile[0].segment_label == "High-Value"
    assert sum(r.customers for r in profile) == customers.count()
    assert [r.monetary for r in profile] == sorted((r.monetary for r in profile), reverse=True)


def test_failures_are_reported(spark):
    def broken():
        raise RuntimeError("no data")

    done, failed = models.run_ml(spark, {"a": lambda: {"x": 1}, "b": broken})
    assert [tuple(r) for r in done.collect()] == [("a", "x", 1.0)] and failed == {"b": "no data"}
