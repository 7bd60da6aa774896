"""Feature tables for the models: one row per customer, product-week, or store-day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from shopgrain.functions.columns import as_of_date, mean, quotient
from shopgrain.operators.global_order import GlobalOrder
from shopgrain.operators.gold import Gold
from shopgrain.operators.silver import PRICE_TIERS, catalogue_columns
from shopgrain.sources.retail import Retail

CHURN_DAYS = 90
# Categories with an indicator column of their own.
CATEGORIES = ("Electronics", "Apparel", "Books", "Furniture", "Sports", "Food")


def indicators(column: str, values: Sequence[str], prefix: str) -> list[Column]:
    """A 0/1 column per value."""
    return [
        F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(
            f"{prefix}_{v.replace('-', '_').lower()}"
        )
        for v in values
    ]


def _known_lines(t: Retail) -> DataFrame:
    """Sums of the lines of known products, by order and category; other lines count nowhere."""
    total = F.col("total")
    return (
        t.sales.join(t.products.select("product_id", "category"), "product_id")
        .groupBy("order_id", "category")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("total").alias("revenue"),
            F.sum(total * total).alias("squares"),
            F.max("total").alias("highest"),
            F.min("total").alias("lowest"),
            F.sum("discount").alias("discounts"),
            F.sum("profit").alias("profit"),
        )
    )


def _order_behaviour(t: Retail, as_of: str) -> DataFrame:
    """Per customer: amounts over lines, counts over orders."""
    sums = ("lines", "revenue", "squares", "discounts", "profit")
    per_order = (
        _known_lines(t)
        .groupBy("order_id")
        .agg(*[F.sum(c).alias(c) for c in sums], F.max("highest").alias("highest"), F.min("lowest").alias("lowest"))
    )
    age = F.datediff(as_of_date(as_of), "order_date")
    # The spread of the lines follows from their sums, so lines are never moved.
    n, s, q = (F.col(c).cast("double") for c in ("lines", "monetary", "squares"))
    deviation = F.when(F.col("lines") > 1, F.sqrt(F.greatest((q - s * s / n) / (n - 1), F.lit(0.0))))
    return (
        t.orders.join(per_order, "order_id")
        .groupBy("customer_id")
        .agg(
            F.min(age).alias("recency_days"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum("revenue").alias("monetary"),
            mean("revenue", 4, count="lines").alias("avg_order_value"),
            F.max("highest").alias("max_order_value"),
            F.min("lowest").alias("min_order_value"),
            mean("discounts", 4, count="lines").alias("avg_discount"),
            F.sum("profit").alias("profit_contribution"),
            F.count_distinct("store_id").alias("distinct_stores"),
            F.datediff(F.max("order_date"), F.min("order_date")).alias("order_span_days"),
            F.count_if(age <= 30).alias("orders_last_30d"),
            F.count_if(age <= 90).alias("orders_last_90d"),
            F.sum("lines").alias("lines"),
            F.sum("squares").alias("squares"),
        )
        .withColumn("std_order_value", F.coalesce(F.round(deviation, 4), F.lit(0.0)))
        .drop("lines", "squares")
    )


def _category_behaviour(t: Retail) -> DataFrame:
    """Per customer: categories bought, and the one with the most lines (first by name)."""
    per_category = (
        _known_lines(t)
        .select("order_id", "category", "lines")
        .join(t.order_heads.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id", "category")
        .agg(F.sum("lines").alias("lines"))
    )
    most = F.min(F.struct((-F.col("lines")).alias("n"), F.col("category").alias("category")))
    return per_category.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("distinct_categories"), most["category"].alias("preferred_category")
    )


def customer_features(
    t: Retail, as_of: str, categories: Sequence[str] = CATEGORIES, churn_days: int = CHURN_DAYS
) -> DataFrame:
    demography = t.customers.select(
        "customer_id",
        (F.col("gender") == "Male").cast("int").alias("gender_male"),
        F.datediff(as_of_date(as_of), "join_date").alias("tenure_days"),
    )
    joined = (
        _order_behaviour(t, as_of)
        .join(_category_behaviour(t), "customer_id", "left")
        .join(demography, "customer_id", "left")
    )
    return (
        joined.withColumn("is_churned", (F.col("recency_days") > churn_days).cast("int"))
        .withColumn("lifetime_value", F.col("monetary"))
        .select("*", *indicators("preferred_category", categories, "cat"))
        .drop("preferred_category")
        .fillna(0)
    )


def product_features(t: Retail, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Weekly units per product. Weeks are ISO weeks with the year they belong to."""
    week, year = F.weekofyear("order_date"), F.extract(F.lit("yearofweek"), F.col("order_date"))
    dated = t.sales.groupBy("order_id", "product_id").agg(F.sum("quantity").alias("units")).join(
        t.order_heads.select("order_id", week.alias("week"), year.alias("year")), "order_id"
    )
    weekly = dated.groupBy("product_id", "year", "week").agg(F.sum("units").alias("units_sold"))
    # A product has one row per calendar week, which bounds its window.
    w = Window.partitionBy("product_id").orderBy("year", "week")
    lagged = weekly.select(
        "*",
        *[F.lag("units_sold", k).over(w).alias(f"lag_{k}w") for k in (1, 2, 4)],
        F.avg("units_sold").over(w.rowsBetween(-3, 0)).alias("rolling_mean_4w"),
    ).fillna(0)
    catalogue = t.products.withColumns(catalogue_columns()).select(
        "product_id",
        "category",
        "price_tier",
        "cost_price",
        "selling_price",
        F.col("profit_margin").alias("product_profit_margin"),
        "stock",
    )
    return (
        lagged.join(catalogue, "product_id")
        .select(
            "*", *indicators("category", categories, "cat"), *indicators("price_tier", PRICE_TIERS, "tier")
        )
        .drop("category", "price_tier")
        .fillna(0)
    )


def store_features(g: Gold) -> DataFrame:
    """Rows of the daily summary with their store's revenue before them.

    A store has at most one row per day, category and place. Rows of one day follow each
    other by category. Stores are cut into blocks, so one store's rows are no single task's.
    """

    def revenue(w: WindowSpec) -> dict[str, Column]:
        recent = w.rowsBetween(-6, 0)
        return {
            "revenue_lag1": F.lag("total_revenue", 1).over(w),
            "revenue_lag7": F.lag("total_revenue", 7).over(w),
            "revenue_ma7": quotient(
                F.sum("total_revenue").over(recent), F.count("total_revenue").over(recent), 6
            ),
        }

    order = ["sale_date", "category", "store_city", "store_country"]
    framed = GlobalOrder(g.daily_sales_summary).frames(["store_name"], order, 7, revenue).df
    return framed.withColumns(
        {
            "dow": F.dayofweek("sale_date"),
            "dom": F.dayofmonth("sale_date"),
            "mth": F.month("sale_date"),
            "yr": F.year("sale_date"),
        }
    ).fillna(0)


def build_all(g: Gold, categories: Sequence[str] = CATEGORIES) -> dict[str, DataFrame]:
    return {
        "customer": customer_features(g.retail, g.as_of, categories),
        "product": product_features(g.retail, categories),
        "store": store_features(g),
    }
