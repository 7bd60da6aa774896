"""Sales, customer and trend analyses over the gold and cleaned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.functions.columns import as_of_date, label, mean, month_start, percent, quotient
from shopgrain.operators.baskets import basket_lists, order_sizes
from shopgrain.operators.global_order import GlobalOrder
from shopgrain.operators.gold import Gold
from shopgrain.operators.rollups import orders_with_sums, product_sums
from shopgrain.operators.tiles import Order, add_tiles
from shopgrain.sources.retail import Retail
from shopgrain.sources.scratch import settle

_MONTH = ["year", "month", "category"]


def monthly_revenue(g: Gold) -> DataFrame:
    return (
        g.daily_measures.groupBy(*_MONTH)
        .agg(
            F.sum("total_revenue").alias("monthly_revenue"),
            F.sum("units_sold").alias("total_units"),
            F.sum("order_count").alias("total_orders"),
            mean("total_revenue", 6).alias("avg_daily_revenue"),
        )
        .orderBy(*_MONTH)
    )


def top_customers(g: Gold, n: int = 10) -> DataFrame:
    return (
        g.customer_analytics.select(
            "customer_id",
            "first_name",
            "last_name",
            "email",
            "lifetime_value",
            "total_orders",
            "avg_order_value",
            "customer_segment",
            "churn_risk",
        )
        .orderBy(F.desc("lifetime_value"), "customer_id")
        .limit(n)
    )


def product_ranking(g: Gold, top: int = 10) -> DataFrame:
    by_revenue, by_profit = F.col("revenue_rank") <= top, F.col("profit_rank") <= top
    return g.product_performance.select(
        "product_name",
        "category",
        "total_revenue",
        "total_units_sold",
        "profit_margin",
        "revenue_rank",
        "profit_rank",
        label(
            [(by_revenue & by_profit, "Star"), (by_revenue, "Cash Cow"), (by_profit, "High Profit")],
            "Average",
        ).alias("product_category"),
    ).orderBy(F.desc("total_revenue"))


def store_comparison(g: Gold) -> DataFrame:
    return g.store_performance.select(
        "store_name",
        "city",
        "country",
        "region",
        "total_revenue",
        "total_orders",
        "unique_customers",
        "avg_order_value",
        "profit_margin",
        "revenue_rank",
    ).orderBy(F.desc("total_revenue"))


def time_series_growth(g: Gold) -> DataFrame:
    growth = F.col("mom_growth_pct")
    return (
        g.monthly_time_series.where(F.col("prev_month_revenue").isNotNull())
        .select(
            *_MONTH,
            "monthly_revenue",
            "prev_month_revenue",
            "mom_growth_pct",
            label(
                [(growth > 10, "High Growth"), (growth > 0, "Growing"), (growth > -10, "Stable")],
                "Declining",
            ).alias("growth_category"),
        )
        .orderBy(*_MONTH)
    )


def cohort_retention(t: Retail) -> DataFrame:
    """Customers by the month they joined: who bought in that month, who came back."""
    # A customer keeps one row per month with orders, whatever the number of orders.
    active = t.order_heads.select("customer_id", month_start("order_date").alias("active")).distinct()
    joined = t.customers.select("customer_id", month_start("join_date").alias("cohort"))
    per_customer = (
        active.join(joined, "customer_id")
        .groupBy("cohort", "customer_id")
        .agg(
            F.max((F.col("active") == F.col("cohort")).cast("int")).alias("first"),
            F.max((F.col("active") > F.col("cohort")).cast("int")).alias("later"),
        )
    )
    cohorts = per_customer.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        F.sum("first").alias("first_month_customers"),
        F.sum("later").alias("retained_customers"),
    )
    return cohorts.select(
        F.year("cohort").alias("cohort_year"),
        F.month("cohort").alias("cohort_month"),
        "cohort_size",
        "first_month_customers",
        "retained_customers",
        percent("retained_customers", "first_month_customers").alias("retention_rate"),
    ).orderBy(F.desc("cohort_year"), F.desc("cohort_month"))


def cross_sell_orders(t: Retail, n: int = 20) -> DataFrame:
    """The largest orders of two or more products, with what they hold."""
    sizes = order_sizes(t).where(F.col("different") >= 2)
    top = settle(sizes.orderBy(F.desc("product_count"), "order_id").limit(n), "top")
    return (
        basket_lists(t, top)
        .select(
            "order_id",
            F.col("products").alias("products_list"),
            F.col("categories").alias("categories_list"),
            F.size("products").alias("product_count"),
            F.size(F.array_distinct("categories")).alias("category_count"),
        )
        .orderBy(F.desc("product_count"), "order_id")
    )


def recency_frequency_monetary(t: Retail, as_of: str) -> DataFrame:
    """Per customer of the table: days since the last order, orders, net revenue.

    Orders of other customers count for nobody, so no score is spent on them.
    """
    return t.once(
        f"recency_frequency_monetary-{as_of}",
        lambda: orders_with_sums(t)
        .groupBy("customer_id")
        .agg(
            F.datediff(as_of_date(as_of), F.max("order_date")).alias("recency"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum("revenue").alias("monetary"),
        )
        .join(t.customers.select("customer_id"), "customer_id", "left_semi"),
    )


def scored(base: DataFrame, recency: Order, frequency: Order, monetary: Order) -> DataFrame:
    """Quintiles 1-5 in the three given orders."""
    return add_tiles(base, 5, {"r": recency, "f": frequency, "m": monetary})


def rfm_analysis(t: Retail, as_of: str) -> DataFrame:
    """Quintile scores where 1 is the most recent, most frequent, highest spender.

    Segment names follow the scores as given, so "Champions" are high scores.
    ``rfm_segmentation`` has the scores the usual way round.
    """
    return t.once(f"rfm_analysis-{as_of}", lambda: _rfm_analysis(t, as_of))


def _rfm_analysis(t: Retail, as_of: str) -> DataFrame:
    who = ("customer_id", False)
    base = scored(
        recency_frequency_monetary(t, as_of),
        [("recency", False), who],
        [("frequency", True), who],
        [("monetary", True), who],
    )
    r, f, m = F.col("r"), F.col("f"), F.col("m")
    segment = label(
        [
            ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
            ((r >= 4) & (f >= 3) & (m >= 3), "Loyal"),
            ((r >= 3) & (f >= 3) & (m >= 3), "Potential"),
            ((r >= 3) & (f <= 2) & (m >= 2), "At Risk"),
            ((r <= 2) & (f >= 2) & (m >= 2), "Needs Attention"),
        ],
        "Lost",
    )
    names = t.customers.select("customer_id", "first_name", "last_name")
    return (
        base.join(names, "customer_id")
        .select(
            "customer_id",
            "first_name",
            "last_name",
            "recency",
            "frequency",
            F.round("monetary", 2).alias("monetary"),
            r.alias("recency_score"),
            f.alias("frequency_score"),
            m.alias("monetary_score"),
            (r + f + m).alias("total_rfm_score"),
            segment.alias("rfm_segment"),
        )
        .orderBy(F.desc("total_rfm_score"))
    )


def daily_revenue(t: Retail) -> DataFrame:
    """One row per calendar day with orders."""
    return t.once(
        "daily_revenue",
        lambda: orders_with_sums(t)
        .groupBy(F.col("order_date").alias("sale_date"))
        .agg(F.sum("revenue").alias("revenue")),
    )


def trailing(value: str, rows: int, digits: int) -> Column:
    """Mean of this and the ``rows - 1`` days with sales before it.

    One window over all days: the calendar bounds them at some hundred rows a year.
    """
    w = Window.orderBy("sale_date").rowsBetween(1 - rows, Window.currentRow)
    return quotient(F.sum(value).over(w), F.count(value).over(w), digits)


def moving_averages(t: Retail) -> DataFrame:
    return (
        daily_revenue(t)
        .select(
            "sale_date",
            F.col("revenue").alias("daily_revenue"),
            trailing("revenue", 7, 6).alias("moving_avg_7days"),
            trailing("revenue", 30, 6).alias("moving_avg_30days"),
            F.rank().over(Window.orderBy(F.desc("revenue"))).alias("revenue_rank"),
        )
        .orderBy(F.desc("sale_date"))
    )


def against_year_before(monthly: DataFrame, year: str, month: str, revenue: str) -> Column:
    """The same month's revenue a year earlier; NULL when there was none."""
    w = Window.partitionBy(month, "category").orderBy(year).rangeBetween(-1, -1)
    return F.sum(revenue).over(w)


def yoy_comparison(g: Gold) -> DataFrame:
    before = against_year_before(g.monthly_time_series, "year", "month", "monthly_revenue")
    return (
        g.monthly_time_series.select(
            *_MONTH,
            F.col("monthly_revenue").alias("current_year_revenue"),
            before.alias("previous_year_revenue"),
        )
        .withColumn(
            "yoy_growth_pct",
            percent(
                F.col("current_year_revenue") - F.col("previous_year_revenue"), "previous_year_revenue"
            ),
        )
        .orderBy(*_MONTH)
    )


def share_class(running: str, total) -> Column:
    """A up to 80 % of the total, B up to 95 %, else C; compared without rounding."""
    part, whole = F.col(running) * 100, F.lit(total)
    return label([(part <= whole * 80, "A"), (part <= whole * 95, "B")], "C")


def pareto_analysis(t: Retail) -> DataFrame:
    per_product = product_sums(t).select("product_id", F.col("revenue").alias("total"))
    by_name = (
        per_product.join(t.products.select("product_id", "product_name", "category"), "product_id")
        .groupBy("product_name", "category")
        .agg(F.sum("total").alias("total_sales"))
    )
    ordered = GlobalOrder(by_name)
    total = ordered.total("total_sales")
    ranked = ordered.running_sum(
        "total_sales",
        [F.desc("total_sales"), F.col("product_name"), F.col("category")],
        "running_total",
        number="rank",
    ).df
    return ranked.select(
        "product_name",
        "category",
        F.round("total_sales", 2).alias("total_sales"),
        "rank",
        percent("running_total", F.lit(total)).alias("cumulative_percentage"),
        share_class("running_total", total).alias("pareto_category"),
    ).orderBy("rank")
