"""Report tables: pivots, summaries, distributions and headline numbers."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.functions.columns import mean, parse_money, quotient
from shopgrain.operators.baskets import order_sizes
from shopgrain.operators.global_order import GlobalOrder
from shopgrain.operators.gold import Gold
from shopgrain.plans.core import rfm_analysis
from shopgrain.plans.extended import (
    abc_products,
    basket_categories,
    category_country,
    cohort_matrix,
    employee_performance,
    inventory_risk,
    rfm_segmentation,
    seasonality_monthly,
)
from shopgrain.sources.retail import Retail
from shopgrain.sources.scratch import settle

# Month headings, and the percentiles and bins of the value reports.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
PERCENTILES = (10, 25, 50, 75, 90, 95, 99)
BINS = 40


# -- pivots. The heading values are given, so no job is run to find them. ----


def pivot_revenue_month_category(g: Gold, categories: Sequence[str]) -> DataFrame:
    period = F.date_format(F.make_date("year", "month", F.lit(1)), "yyyy-MM")
    return (
        g.monthly_time_series.groupBy(period.alias("period"))
        .pivot("category", list(categories))
        .agg(F.sum("monthly_revenue"))
        .fillna(0)
        .orderBy("period")
    )


def pivot_cohort(t: Retail, months: int = 12) -> DataFrame:
    """Cohort x months since its first order; blank where nobody came back."""
    wide = (
        cohort_matrix(t)
        .groupBy(F.date_format("cohort_month", "yyyy-MM").alias("cohort_month"))
        .pivot("months_since_first", list(range(months)))
        .agg(F.max("retention_pct"))
    )
    return wide.select(
        "cohort_month", *[F.col(str(i)).alias(f"month_{i}") for i in range(months)]
    ).orderBy("cohort_month")


def pivot_country(g: Gold, n: int = 20) -> DataFrame:
    """Category x the countries with the highest revenue."""
    cells = settle(category_country(g).select("category", "store_country", "revenue"), "cells")
    # The headings: at most n names come to the driver.
    by_country = cells.groupBy("store_country").agg(F.sum("revenue").alias("r"))
    names = [r["store_country"] for r in by_country.orderBy(F.desc("r"), "store_country").take(n)]
    return (
        cells.where(F.col("store_country").isin(names))
        .groupBy("category")
        .pivot("store_country", names)
        .agg(F.sum("revenue"))
        .fillna(0)
        .orderBy("category")
    )


def pivot_year_month(g: Gold) -> DataFrame:
    wide = (
        seasonality_monthly(g)
        .groupBy("year")
        .pivot("month", list(range(1, 13)))
        .agg(F.sum("revenue"))
        .fillna(0)
    )
    return wide.select(
        "year", *[F.col(str(i)).alias(name) for i, name in enumerate(MONTHS, 1)]
    ).orderBy("year")


# -- summaries ---------------------------------------------------------------


def customer_segment_summary(g: Gold) -> DataFrame:
    return g.customer_analytics.groupBy("customer_segment").agg(
        F.count("customer_id").alias("customers"),
        mean("lifetime_value", 6).alias("avg_ltv"),
        mean("total_orders", 6).alias("avg_orders"),
    )


def churn_counts(g: Gold) -> DataFrame:
    counts = g.customer_analytics.groupBy("churn_risk").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"))


def rfm_summary(t: Retail, as_of: str) -> DataFrame:
    return (
        rfm_analysis(t, as_of)
        .groupBy("rfm_segment")
        .agg(
            F.count("customer_id").alias("customers"),
            mean("recency", 6).alias("avg_recency"),
            mean("frequency", 6).alias("avg_frequency"),
            mean("monetary", 6).alias("avg_monetary"),
        )
        .orderBy(F.desc("avg_monetary"))
    )


def rfm_ext_summary(t: Retail, as_of: str) -> DataFrame:
    return (
        rfm_segmentation(t, as_of)
        .groupBy("segment")
        .agg(F.count("customer_id").alias("customers"), mean("monetary", 6).alias("avg_revenue"))
        .orderBy(F.desc("avg_revenue"))
    )


def abc_rollup(g: Gold) -> DataFrame:
    return (
        abc_products(g)
        .groupBy("abc_class")
        .agg(
            F.count("product_name").alias("products"),
            F.sum("revenue").alias("total_revenue"),
            mean("profit_margin", 6).alias("avg_margin"),
        )
        .orderBy("abc_class")
    )


def basket_combo_labels(t: Retail, n: int = 15) -> DataFrame:
    combo = F.array_join(F.array_sort(F.array_distinct("cats")), " + ")
    return (
        basket_categories(t)
        .groupBy(combo.alias("combo"))
        .agg(F.sum("order_count").alias("order_count"))
        .orderBy(F.desc("order_count"), "combo")
        .limit(n)
    )


def basket_size_histogram(t: Retail) -> DataFrame:
    """How many orders of two or more products have how many lines; all such orders count."""
    return (
        order_sizes(t)
        .where(F.col("different") >= 2)
        .groupBy("product_count")
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy("product_count")
    )


def daily_category_revenue(g: Gold) -> DataFrame:
    return (
        g.daily_measures.groupBy("sale_date", "category")
        .agg(F.sum("total_revenue").alias("revenue"))
        .orderBy("sale_date", "category")
    )


def department_summary(t: Retail) -> DataFrame:
    return (
        employee_performance(t)
        .groupBy("department")
        .agg(
            F.count("employee_id").alias("employees"),
            mean("revenue_generated", 6).alias("avg_revenue"),
            mean("profit_margin_pct", 6).alias("avg_margin"),
            mean("salary", 6).alias("avg_salary"),
            mean("revenue_to_salary_ratio", 6, unit="decimal(24,6)").alias("avg_rev_salary"),
        )
        .orderBy("department")
    )


def inventory_status_counts(t: Retail) -> DataFrame:
    counts = inventory_risk(t).groupBy(F.col("inventory_status").alias("status"))
    return counts.agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"))


def stockout_top10(t: Retail, n: int = 10) -> DataFrame:
    return (
        inventory_risk(t)
        .where(F.col("inventory_status") == "STOCKOUT RISK")
        .orderBy("days_of_cover", "product_id")
        .limit(n)
        .select("product_name", "category", "stock", "daily_demand", "days_of_cover")
    )


# -- distributions -----------------------------------------------------------


def ltv_percentiles_exact(g: Gold) -> DataFrame:
    """Percentiles with linear interpolation, from row numbers.

    The built-in exact percentile gathers every value in one task; here only the
    two neighbours of each percentile leave the sorted table.
    """
    ordered = GlobalOrder(g.customer_analytics.select("customer_id", "lifetime_value")).row_number(
        [F.col("lifetime_value"), F.col("customer_id")], "rn"
    )
    wanted = []
    for p in PERCENTILES:
        below, part = divmod(max(ordered.rows - 1, 0) * p, 100)
        wanted.append((p, below + 1, 100 - part))
        if part:
            wanted.append((p, below + 2, part))
    points = g.retail.sales.sparkSession.createDataFrame(wanted, "p int, rn bigint, weight int")
    return (
        ordered.df.join(F.broadcast(points), "rn")
        .groupBy("p")
        .agg(quotient(F.sum(F.col("lifetime_value") * F.col("weight")), F.lit(100), 2).alias("ltv"))
        .orderBy("p")
        .select(F.concat(F.lit("P"), "p").alias("percentile"), "ltv")
    )


def ltv_histogram(g: Gold, bins: int = BINS) -> DataFrame:
    """Equal bins between the lowest and highest value; the last includes its upper edge."""
    values = settle(g.customer_analytics.select("lifetime_value"), "values")
    low, high = values.agg(F.min("lifetime_value"), F.max("lifetime_value")).first()
    if low is None:
        low = high = Decimal(0)
    if low == high:
        low, high = low - Decimal("0.5"), high + Decimal("0.5")
    # Whole-number division, so that a value just below an edge is not rounded over it.
    position = F.call_function("div", (F.col("lifetime_value") - F.lit(low)) * bins, F.lit(high - low))
    counts = (
        values.groupBy(F.least(position.cast("int"), F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("customers"))
    )

    def edge(bin_number: Column) -> Column:
        return F.round(F.lit(low) + bin_number * F.lit(high - low) / bins, 4)

    every = values.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        every.join(counts, "bin", "left")
        .select(
            "bin",
            edge(F.col("bin")).alias("low"),
            edge(F.col("bin") + 1).alias("high"),
            F.coalesce("customers", F.lit(0)).alias("customers"),
        )
        .orderBy("bin")
    )


# -- headline numbers --------------------------------------------------------


def executive_kpis(g: Gold) -> DataFrame:
    """One row per headline number."""
    customers = g.customer_analytics.agg(
        F.count("customer_id").alias("total_customers"),
        F.round(F.sum("lifetime_value"), 0).alias("total_revenue"),
        mean("lifetime_value", 2).alias("avg_ltv"),
        mean("total_orders", 2).alias("avg_orders_per_customer"),
        F.count_if(F.col("churn_risk") == "High").alias("high_churn_customers"),
    )
    products = g.product_measures.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.round(F.sum("total_revenue"), 0).alias("product_revenue"),
        mean("profit_margin", 2).alias("avg_margin"),
    )
    # The last rank is one more than the stores above the lowest revenue: no ranking is needed.
    at_revenue = g.store_measures.groupBy("total_revenue").agg(
        F.count(F.lit(1)).alias("n"), F.sum("profit_margin").alias("margins"), F.count("profit_margin").alias("with_margin")
    )
    stores = at_revenue.agg(
        F.sum("n").alias("total_stores"),
        mean("margins", 2, count="with_margin").alias("avg_store_margin"),
        (F.sum("n") - F.min_by("n", "total_revenue") + 1).alias("ranked_stores"),
    )

    def as_rows(one: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("kpi"), F.col(c).cast("double").alias("value")) for c in one.columns]
        return one.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*")

    return as_rows(customers).unionByName(as_rows(products)).unionByName(as_rows(stores))


def parsed_money(g: Gold) -> DataFrame:
    """Lifetime values read back from the text reports show; what is no amount gives null."""
    shown = F.concat(F.lit("£"), F.format_number("lifetime_value", 2))
    text = F.when(F.col("churn_risk") == "High", "n/a").otherwise(shown)
    return g.customer_analytics.select(
        "customer_id", text.alias("shown"), parse_money(text).alias("lifetime_value")
    )


def sample_rows(df: DataFrame, key: str, n: int = 300, seed: int = 42) -> DataFrame:
    """Up to ``n`` rows, picked by the md5 of a seed and the key."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(key)).cast("binary")), key).limit(n)
