"""Models and their measures as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.plans import models
from shopgrain.plans.features import customer_features, product_features
from shopgrain.sources.retail import Retail

# Small grids for tests of the training functions; no registered query uses them.
SMALL_BOOSTED = {"maxIter": [10], "maxDepth": [3, 4], "stepSize": [0.1]}
SMALL_FOREST = {"numTrees": [10], "maxDepth": [5], "minInstancesPerNode": [1, 3]}


class ModelQueries:
    """The queries over one set of tables, with its category names."""

    def __init__(self, as_of: str, categories: tuple[str, ...]):
        self.as_of, self.categories = as_of, categories

    def _customers(self, t: Retail) -> DataFrame:
        return customer_features(t, self.as_of, self.categories)

    def train_churn(self, spark: SparkSession, t: Retail) -> DataFrame:
        trained = models.train_churn(self._customers(t))
        return models.metrics_frame(spark, {"churn": trained.metrics, "importance": dict(trained.importances)})

    def train_ltv(self, spark: SparkSession, t: Retail) -> DataFrame:
        trained = models.train_ltv(self._customers(t))
        return models.metrics_frame(spark, {"ltv": trained.metrics, "importance": dict(trained.importances)})

    def train_demand(self, spark: SparkSession, t: Retail) -> DataFrame:
        trained = models.train_demand(product_features(t, self.categories))
        return models.metrics_frame(spark, {"demand": trained.metrics, "importance": dict(trained.importances)})

    def segment_customers(self, spark: SparkSession, t: Retail) -> DataFrame:
        return models.segment_customers(self._customers(t)).customers

    def cluster_profile(self, spark: SparkSession, t: Retail) -> DataFrame:
        return models.cluster_profile(models.segment_customers(self._customers(t)).customers)

    def run_ml(self, spark: SparkSession, t: Retail) -> DataFrame:
        customers, products = self._customers(t), product_features(t, self.categories)
        done, failed = models.run_ml(spark, models.all_models(customers, products))
        lost = spark.createDataFrame([(name, "failed", None) for name in failed], done.schema)
        return done.unionByName(lost)

    # -- measures, on predictions made by a fixed rule -----------------------

    def _scored(self, t: Retail) -> DataFrame:
        f = self._customers(t)
        return f.select(
            F.col("is_churned").alias("label"),
            (F.col("frequency") <= 9).cast("int").alias("prediction"),
            (-F.col("frequency")).cast("double").alias("score"),
            F.col("monetary").cast("double").alias("value"),
            (F.col("frequency") * 200000.0).alias("estimate"),
        )

    def evaluate_classifier(self, spark: SparkSession, t: Retail) -> DataFrame:
        measured = models.evaluate_classifier(self._scored(t), "label", "prediction", "score")
        return measured.select(*[F.round(c, 6).alias(c) for c in measured.columns])

    def classification_report(self, spark: SparkSession, t: Retail) -> DataFrame:
        rounded = [F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
        report = models.classification_report(self._scored(t), "label", "prediction")
        return report.select("class", *rounded, "support")

    def evaluate_regressor(self, spark: SparkSession, t: Retail) -> DataFrame:
        measured = models.evaluate_regressor(self._scored(t), "value", "estimate")
        digits = {"mae": 4, "rmse": 4, "r2": 6, "mape": 6}
        return measured.select(*[F.round(c, d).alias(c) for c, d in digits.items()])

    def named(self) -> dict:
        names = (
            "train_churn train_ltv train_demand segment_customers cluster_profile run_ml"
            " evaluate_classifier classification_report evaluate_regressor"
        )
        return {name: getattr(self, name) for name in names.split()}
