"""The stand-alone report queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.functions.columns import (
    FINE,
    as_of_date,
    label,
    mean,
    percent,
    quotient,
    season,
)
from shopgrain.operators.baskets import basket_lists, basket_marks, of_known_orders, order_products
from shopgrain.operators.global_order import GlobalOrder
from shopgrain.operators.gold import Gold
from shopgrain.operators.rollups import (
    day_category_sums,
    order_product_sums,
    orders_with_sums,
    sums_again,
)
from shopgrain.plans.core import against_year_before, time_series_growth
from shopgrain.sources.retail import Retail
from shopgrain.sources.scratch import settle


def sales_dashboard_daily(g: Gold, since: str) -> DataFrame:
    return (
        g.daily_sales_summary.where(F.col("sale_date") >= as_of_date(since))
        .select(
            "sale_date",
            "category",
            "total_revenue",
            "units_sold",
            "order_count",
            "unique_customers",
            quotient("total_revenue", "order_count", 2).alias("avg_order_value"),
            "profit_margin",
        )
        .orderBy(F.desc("sale_date"), F.desc("total_revenue"))
    )


def top_products_gold(g: Gold, n: int = 20) -> DataFrame:
    return (
        g.product_performance.orderBy(F.desc("total_revenue"), "product_id")
        .limit(n)
        .select(
            "product_name",
            "category",
            "total_revenue",
            "total_units_sold",
            "profit_margin",
            "revenue_rank",
            "performance_score",
        )
    )


def segment_summary(g: Gold) -> DataFrame:
    return (
        g.customer_analytics.groupBy("customer_segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            mean("lifetime_value", 6).alias("avg_lifetime_value"),
            mean("total_orders", 6).alias("avg_orders"),
            mean("avg_order_value", 6, unit=FINE).alias("avg_order_value"),
            F.sum("lifetime_value").alias("total_segment_value"),
        )
        .orderBy(F.desc("total_segment_value"))
    )


def store_matrix(g: Gold) -> DataFrame:
    margin, place = F.col("profit_margin"), F.col("revenue_rank")
    return g.store_performance.select(
        "store_name",
        "city",
        "region",
        "total_revenue",
        "total_orders",
        "unique_customers",
        "avg_order_value",
        "profit_margin",
        "revenue_rank",
        label(
            [
                ((margin > 30) & (place <= 5), "Star"),
                (margin > 30, "High Profit"),
                (place <= 5, "High Revenue"),
                ((margin < 15) & (place > 20), "Underperforming"),
            ],
            "Average",
        ).alias("store_category"),
    ).orderBy(F.desc("total_revenue"))


def mom_growth_year(g: Gold, year: int) -> DataFrame:
    return time_series_growth(g).where(F.col("year") == year)


def ltv_buckets(g: Gold, borders: tuple[int, ...] = (1000, 5000, 10000, 50000)) -> DataFrame:
    names = [f"{b // 1000}K" for b in borders]
    ltv = F.col("lifetime_value")
    bucket = label(
        [(ltv < b, f"{low}-{high}") for b, low, high in zip(borders, ["0", *names], names)],
        f"{names[-1]}+",
    )
    return (
        g.customer_analytics.groupBy(bucket.alias("lifetime_value_bucket"))
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.sum("lifetime_value").alias("total_clv"),
            mean("lifetime_value", 6).alias("avg_clv"),
            mean("total_orders", 6).alias("avg_orders"),
            F.min("lifetime_value").alias("lowest"),
        )
        .orderBy("lowest")
        .drop("lowest")
    )


def product_combinations(t: Retail, n: int = 20) -> DataFrame:
    """The baskets that occur most often, each shown by its first order."""
    top = (
        of_known_orders(t, basket_marks(order_products(t)))
        .where(F.col("lines") > 1)
        .groupBy("mark_a", "mark_b", "lines")
        .agg(F.count(F.lit(1)).alias("order_count"), F.min("order_id").alias("order_id"))
        .orderBy(F.desc("order_count"), "order_id")
        .limit(n)
    )
    top = settle(top, "top")
    return (
        basket_lists(t, top)
        .join(top.select("order_id", "order_count"), "order_id")
        .orderBy(F.desc("order_count"), "order_id")
        .select("products", "categories", "order_count")
    )


def seasonal_sales(g: Gold) -> DataFrame:
    return (
        g.daily_measures.groupBy(season("month").alias("season"), "category")
        .agg(
            F.sum("total_revenue").alias("seasonal_revenue"),
            mean("total_revenue", 6).alias("avg_daily_revenue"),
            F.sum("units_sold").alias("total_units"),
        )
        .orderBy("season", F.desc("seasonal_revenue"))
    )


def inventory_turnover_class(g: Gold) -> DataFrame:
    days = F.col("inventory_turnover_days")
    return (
        g.product_measures.where(days.isNotNull())
        .select(
            "product_name",
            "category",
            "stock",
            "total_units_sold",
            "profit_margin",
            "inventory_turnover_days",
            label([(days < 30, "Fast Moving"), (days < 90, "Medium Moving")], "Slow Moving").alias(
                "inventory_category"
            ),
        )
        .orderBy("inventory_turnover_days")
    )


def yoy_from_daily(t: Retail) -> DataFrame:
    """Year over year from the dated sales, without the gold series."""
    monthly = (
        day_category_sums(t)
        .groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month"), "category")
        .agg(F.sum("revenue").alias("current_year_revenue"))
    )
    before = against_year_before(monthly, "year", "month", "current_year_revenue")
    return (
        monthly.withColumn("previous_year_revenue", before)
        .withColumn(
            "yoy_growth_pct",
            percent(
                F.col("current_year_revenue") - F.col("previous_year_revenue"), "previous_year_revenue"
            ),
        )
        .orderBy("year", "month", "category")
    )


def whole_years(start: Column, end: Column) -> Column:
    """Completed years between two dates."""
    day_of_year = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    return F.year(end) - F.year(start) - (day_of_year(end) < day_of_year(start)).cast("int")


def cltv_prediction(t: Retail, as_of: str) -> DataFrame:
    spent = (
        orders_with_sums(t)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("revenue").alias("total_spent"),
            F.sum("lines").alias("lines"),
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("last_order"),
        )
    )
    years = whole_years(F.col("first_order"), as_of_date(as_of)) + 1
    return (
        spent.join(t.customers.select("customer_id", "first_name", "last_name"), "customer_id")
        .select(
            "customer_id",
            F.concat_ws(" ", "first_name", "last_name").alias("customer_name"),
            "order_count",
            "total_spent",
            quotient("total_spent", "lines", 6).alias("avg_order_value"),
            "first_order",
            "last_order",
            F.datediff("last_order", "first_order").alias("days_active"),
            quotient(
                "total_spent", F.datediff("last_order", "first_order"), 2, times=365
            ).alias("annual_spend"),
            quotient(F.col("total_spent") * years, "lines", 2).alias("predicted_lifetime_value"),
        )
        .orderBy(F.desc("predicted_lifetime_value"))
    )


def product_season(t: Retail) -> DataFrame:
    # Lines are summed to order and product before anything is joined.
    dated = order_product_sums(t).join(
        t.order_heads.select("order_id", season(F.month("order_date")).alias("season")), "order_id"
    )
    per_product = dated.groupBy("product_id", "season").agg(
        F.sum("revenue").alias("total"), F.sum("units").alias("units")
    )
    return (
        per_product.join(t.products.select("product_id", "product_name", "category"), "product_id")
        .groupBy("product_name", "category", "season")
        .agg(F.sum("total").alias("total_sales"), F.sum("units").alias("units_sold"))
        .orderBy("category", "season", F.desc("total_sales"))
    )


def inventory_days(t: Retail, as_of: str, window_days: int = 365) -> DataFrame:
    """Stock cover from the trailing year.

    Products sold only before it drop out; products never sold stay, without cover.
    """
    recent = F.col("order_date").isNull() | (
        F.col("order_date") >= F.date_sub(as_of_date(as_of), window_days)
    )
    sold = (
        order_product_sums(t).join(t.order_heads.select("order_id", "order_date"), "order_id", "left")
        .groupBy("product_id")
        .agg(
            F.sum(F.when(recent, F.col("units"))).alias("units"),
            F.sum(F.when(recent, F.col("revenue"))).alias("total"),
            F.count(F.when(recent, 1)).alias("recent_lines"),
        )
    )
    units = F.coalesce("units", F.lit(0))
    return (
        t.products.join(sold, "product_id", "left")
        .where(F.col("recent_lines").isNull() | (F.col("recent_lines") > 0))
        .select(
            "product_id",
            "product_name",
            "category",
            F.col("stock").alias("current_stock"),
            units.alias("units_sold"),
            F.coalesce("total", F.lit(0).cast("decimal(18,2)")).alias("revenue"),
            (F.col("stock").cast("double") / F.nullif(units, F.lit(0)) * 365).alias("days_of_inventory"),
        )
        .orderBy("days_of_inventory")
    )


def purchase_pattern(t: Retail) -> DataFrame:
    """Each day a customer bought, against the day they bought before.

    A customer has at most one row per calendar day, which bounds the window.
    """
    days = (
        orders_with_sums(t)
        .groupBy("customer_id", "order_date")
        .agg(F.sum("revenue").alias("total_spent"))
        .join(t.customers.select("customer_id"), "customer_id", "left_semi")
    )
    w = Window.partitionBy("customer_id").orderBy("order_date")
    return (
        days.withColumn("previous_order_date", F.lag("order_date").over(w))
        .withColumn("previous_spent", F.lag("total_spent").over(w))
        .withColumn("days_between_orders", F.datediff("order_date", "previous_order_date"))
        .withColumn("spending_change", F.col("total_spent") - F.col("previous_spent"))
        .orderBy("customer_id", "order_date")
    )


def store_comparison_ranked(t: Retail) -> DataFrame:
    names = ["store_name", "city", "country"]
    known = t.customers.select("customer_id")
    per_customer = (
        orders_with_sums(t, store=True)
        .join(t.stores.select("store_id", *names), "store_id")
        .groupBy(*names, "customer_id")
        .agg(*sums_again(), F.count(F.lit(1)).alias("orders"))
        .join(known, "customer_id", "left_semi")
    )
    stores = per_customer.groupBy(*names).agg(
        F.sum("orders").alias("total_orders"),
        F.sum("revenue").alias("total_revenue"),
        mean("revenue", 6, count="lines").alias("avg_order_value"),
        F.count("customer_id").alias("unique_customers"),
        F.sum("profit").alias("total_profit"),
        percent(F.sum("profit"), F.sum("revenue")).alias("profit_margin"),
    )
    ranked = (
        GlobalOrder(stores)
        .rank("total_revenue", "revenue_rank", *names)
        .rank("total_profit", "profit_rank", *names)
    )
    return ranked.df.orderBy(F.desc("total_revenue"))
