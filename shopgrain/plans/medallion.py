"""The layers in order: raw, cleaned, gold, analyses, models."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from shopgrain.operators.bronze import bronze_ingest_all
from shopgrain.operators.gold import GOLD_TABLES, CustomerRules, Gold
from shopgrain.operators.silver import silver_process_all
from shopgrain.plans import models
from shopgrain.plans.analyses import run_all
from shopgrain.plans.features import CATEGORIES, customer_features, product_features
from shopgrain.sources.layers import read_layer, write_layer
from shopgrain.sources.retail import TABLES, Retail, SharedRetail
from shopgrain.sources.scratch import freeing, passing

log = logging.getLogger(__name__)

STEPS = ("bronze", "silver", "gold", "analytics", "ml")


class StoredGold(Gold):
    """Gold tables as written, instead of derived again by each analysis."""

    def __init__(self, retail: Retail, as_of: str, read: Callable[[str], DataFrame]):
        super().__init__(retail, as_of)
        object.__setattr__(self, "_stored", read)

    @cached_property
    def daily_sales_summary(self) -> DataFrame:
        return self._stored("daily_sales_summary")

    @cached_property
    def customer_analytics(self) -> DataFrame:
        return self._stored("customer_analytics")

    @cached_property
    def product_performance(self) -> DataFrame:
        return self._stored("product_performance")

    @property
    def daily_measures(self) -> DataFrame:
        return self.daily_sales_summary

    @property
    def product_measures(self) -> DataFrame:
        return self.product_performance

    @cached_property
    def store_performance(self) -> DataFrame:
        return self._stored("store_performance")

    @property
    def store_measures(self) -> DataFrame:
        return self.store_performance

    @cached_property
    def monthly_time_series(self) -> DataFrame:
        return self._stored("monthly_time_series")


class Medallion:
    """The layer tables under one root, fed from a source.

    ``read_source`` opens a source table by name: a JDBC read, or any DataFrame.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        read_source: Callable[[str], DataFrame],
        as_of: str,
        categories: Sequence[str] = CATEGORIES,
        cleaning: Mapping[str, dict] | None = None,
        rules: CustomerRules = CustomerRules(),
    ):
        self.spark, self.root, self.read_source, self.as_of = spark, root, read_source, as_of
        self.categories, self.cleaning, self.rules = categories, cleaning or {}, rules

    def table(self, layer: str, name: str) -> DataFrame:
        return read_layer(self.spark, self.root, layer, name)

    def _raw_or_source(self, name: str) -> DataFrame:
        """Employees and stores come from the source while their raw table is missing."""
        try:
            return self.table("bronze", name)
        except FileNotFoundError:
            if name in ("employees", "stores"):
                return self.read_source(name)
            raise

    def retail(self) -> Retail:
        return Retail(**{name: self.table("silver", name) for name in TABLES})

    def gold_tables(self) -> StoredGold:
        return StoredGold(self.retail(), self.as_of, lambda name: self.table("gold", name))

    # -- steps --------------------------------------------------------------

    def bronze(self) -> None:
        with freeing(self.spark):
            for name, df in bronze_ingest_all(self.read_source).items():
                write_layer(df, self.root, "bronze", name)

    def silver(self) -> None:
        with freeing(self.spark):
            for name, df in silver_process_all(self._raw_or_source, options=self.cleaning).items():
                write_layer(df, self.root, "silver", name)

    def gold(self) -> None:
        # What the tables share is written between them, so no query holds all shuffles of its rows at a time.
        derived = Gold(SharedRetail(self.retail()), self.as_of, self.rules)
        with passing(self.spark), freeing(self.spark):
            for name in GOLD_TABLES:
                if name == "monthly_time_series":
                    # From the daily table just written, not from the sales again.
                    derived.__dict__["daily_measures"] = self.table("gold", "daily_sales_summary")
                write_layer(getattr(derived, name), self.root, "gold", name)

    def analytics(
        self, csv_folder: str | None = None, names: Sequence[str] | None = None
    ) -> tuple[dict[str, DataFrame], dict[str, str]]:
        return run_all(self.gold_tables(), names, csv_folder)

    def ml(self, **options) -> tuple[DataFrame, dict[str, str]]:
        retail = self.retail()
        customers = customer_features(retail, self.as_of, self.categories)
        products = product_features(retail, self.categories)
        return models.run_ml(self.spark, models.all_models(customers, products, **options))

    def run(self, layer: str = "all") -> dict[str, float]:
        """Run one step, or all in order; the seconds each took."""
        if layer != "all" and layer not in STEPS:
            raise ValueError(f"unknown layer {layer!r}; known: all, {', '.join(STEPS)}")
        seconds = {}
        for step in STEPS if layer == "all" else (layer,):
            started = time.monotonic()
            if step == "analytics":
                self.analytics(f"{self.root}/analytics")
            else:
                getattr(self, step)()
            seconds[step] = round(time.monotonic() - started, 3)
            log.info("%s took %.1f s", step, seconds[step])
        return seconds
