"""Segmentation, trend, anomaly and inventory analyses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.functions.columns import label, mean, month_start, percent, quotient
from shopgrain.operators.baskets import of_known_orders, order_products
from shopgrain.operators.global_order import GlobalOrder
from shopgrain.operators.gold import Gold
from shopgrain.operators.rollups import order_product_sums, orders_with_sums
from shopgrain.plans.core import (
    daily_revenue,
    recency_frequency_monetary,
    scored,
    share_class,
    trailing,
)
from shopgrain.sources.retail import Retail
from shopgrain.sources.scratch import settle

# Weekday names in calendar order.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
LTV_POINTS = {"p10": 0.10, "p25": 0.25, "median": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95}


def cohort_activity(t: Retail, months: int = 12) -> DataFrame:
    """Cohort month, months since, active customers, cohort size."""
    return t.once(f"cohort_activity-{months}", lambda: _cohort_activity(t, months))


def _cohort_activity(t: Retail, months: int) -> DataFrame:
    # One row per customer and month; a customer's window holds its months only.
    active = t.order_heads.select("customer_id", month_start("order_date").alias("month")).distinct()
    first = F.min("month").over(Window.partitionBy("customer_id"))
    counts = (
        active.withColumn("cohort_month", first)
        .withColumn("months_since", F.months_between("month", "cohort_month").cast("int"))
        .where(F.col("months_since") < months)
        .groupBy("cohort_month", "months_since")
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    # Everyone of a cohort is active in its month 0.
    size = F.max(F.when(F.col("months_since") == 0, F.col("customers"))).over(
        Window.partitionBy("cohort_month")
    )
    return counts.withColumn("cohort_size", size)


def cohort_matrix(t: Retail) -> DataFrame:
    return (
        cohort_activity(t)
        .select(
            "cohort_month",
            "cohort_size",
            F.col("months_since").alias("months_since_first"),
            F.col("customers").alias("active_customers"),
            percent("customers", "cohort_size", 1).alias("retention_pct"),
        )
        .orderBy("cohort_month", "months_since_first")
    )


def rfm_segmentation(t: Retail, as_of: str) -> DataFrame:
    """Quintile scores where 5 is best, their code, and nine segments."""
    return t.once(f"rfm_segmentation-{as_of}", lambda: _rfm_segmentation(t, as_of))


def _rfm_segmentation(t: Retail, as_of: str) -> DataFrame:
    who = ("customer_id", False)
    base = recency_frequency_monetary(t, as_of).withColumn("monetary", F.round("monetary", 2))
    scores = scored(
        base,
        [("recency", True), who],
        [("frequency", False), who],
        [("monetary", False), who],
    )
    r, f, m = F.col("r"), F.col("f"), F.col("m")
    segment = label(
        [
            ((r == 5) & (f >= 4) & (m >= 4), "Champions"),
            ((r >= 4) & (f >= 3) & (m >= 3), "Loyal Customers"),
            ((r >= 4) & (f <= 2), "New Customers"),
            ((r == 3) & (f >= 3), "Potential Loyalists"),
            ((r == 3) & (f <= 2) & (m >= 3), "Promising"),
            ((r <= 2) & (f >= 4) & (m >= 4), "At Risk"),
            ((r <= 2) & (f >= 3) & (m >= 3), "Cant Lose Them"),
            ((r <= 2) & (f <= 2) & (m >= 3), "Hibernating"),
        ],
        "Lost",
    )
    people = t.customers.select("customer_id", "first_name", "last_name", "city", "country")
    return (
        scores.join(people, "customer_id")
        .select(
            "customer_id",
            "first_name",
            "last_name",
            "city",
            "country",
            F.col("recency").alias("recency_days"),
            "frequency",
            "monetary",
            r.alias("r_score"),
            f.alias("f_score"),
            m.alias("m_score"),
            (r + f + m).alias("rfm_total"),
            F.concat(r, f, m).alias("rfm_code"),
            segment.alias("segment"),
        )
        .orderBy(F.desc("rfm_total"))
    )


def rfm_segment_summary(t: Retail, as_of: str) -> DataFrame:
    return (
        rfm_segmentation(t, as_of)
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            mean("monetary", 2).alias("avg_revenue"),
            mean("recency_days", 1).alias("avg_recency_days"),
        )
        .orderBy(F.desc("avg_revenue"))
    )


def abc_products(g: Gold) -> DataFrame:
    return g.retail.once("abc_products", lambda: _abc_products(g))


def _abc_products(g: Gold) -> DataFrame:
    ordered = GlobalOrder(
        g.product_measures.select(
            "product_id", "product_name", "category", "total_revenue", "total_units_sold", "profit_margin"
        )
    )
    total = ordered.total("total_revenue")
    running = ordered.running_sum(
        "total_revenue", [F.desc("total_revenue"), F.col("product_id")], "running"
    ).df
    return running.select(
        "product_name",
        "category",
        "total_units_sold",
        "profit_margin",
        percent("running", F.lit(total)).alias("cumulative_pct"),
        share_class("running", total).alias("abc_class"),
        F.round("total_revenue", 2).alias("revenue"),
    ).orderBy(F.desc("revenue"))


def abc_summary(g: Gold) -> DataFrame:
    return (
        abc_products(g)
        .groupBy("abc_class")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            F.sum("revenue").alias("total_revenue"),
            mean("profit_margin", 2).alias("avg_margin"),
        )
        .orderBy("abc_class")
    )


def basket_categories(t: Retail, n: int = 20) -> DataFrame:
    """Category sets of orders with two or more products, most frequent first."""
    return t.once(f"basket_categories-{n}", lambda: _basket_categories(t, n))


def _basket_categories(t: Retail, n: int) -> DataFrame:
    per_category = order_products(t).groupBy("order_id", "category").agg(
        F.count(F.lit(1)).alias("different")
    )
    # An order's list holds each category once, so the catalogue's categories bound it.
    sets = (
        per_category.groupBy("order_id")
        .agg(
            F.sum("different").alias("different"),
            F.sort_array(F.collect_list("category")).alias("cats"),
        )
        .where(F.col("different") >= 2)
    )
    return (
        of_known_orders(t, sets)
        .groupBy("cats")
        .agg(F.count(F.lit(1)).alias("order_count"))
        .select("cats", F.size("cats").alias("distinct_categories"), "order_count")
        .orderBy(F.desc("order_count"), "cats")
        .limit(n)
    )


def revenue_trend(t: Retail) -> DataFrame:
    before = F.lag("revenue").over(Window.orderBy("sale_date"))
    return (
        daily_revenue(t)
        .select(
            "sale_date",
            F.round("revenue", 2).alias("daily_revenue"),
            trailing("revenue", 7, 2).alias("ma_7d"),
            trailing("revenue", 30, 2).alias("ma_30d"),
            F.round(F.col("revenue") - before, 2).alias("day_over_day"),
        )
        .orderBy(F.desc("sale_date"))
    )


def value_distribution(values: DataFrame, column: str, mean_name: str) -> DataFrame:
    """Percentiles from a mergeable sketch, mean and deviation: one row."""
    points = F.percentile_approx(column, list(LTV_POINTS.values()), 10000)
    return values.agg(
        points.alias("points"),
        mean(column, 2).alias(mean_name),
        F.round(F.stddev(F.col(column).cast("double")), 2).alias("std_dev"),
        F.count(F.lit(1)).alias("total_customers"),
    ).select(
        *[F.round(F.col("points")[i], 2).alias(name) for i, name in enumerate(LTV_POINTS)],
        mean_name,
        "std_dev",
        "total_customers",
    )


def ltv_distribution(g: Gold) -> DataFrame:
    return value_distribution(g.customer_analytics.select("lifetime_value"), "lifetime_value", "mean")


def category_country(g: Gold) -> DataFrame:
    return (
        g.daily_measures.groupBy("category", "store_country")
        .agg(
            F.sum("total_revenue").alias("revenue"),
            F.sum("units_sold").alias("units"),
            mean("profit_margin", 2).alias("avg_margin"),
        )
        .orderBy(F.desc("revenue"))
    )


def discount_bucket(discount: Column) -> Column:
    """Half-open buckets, so that a fraction between two whole percents has one."""
    return label(
        [(discount == 0, "0%"), (discount <= 10, "1-10%"), (discount <= 20, "11-20%"), (discount <= 30, "21-30%")],
        ">30%",
    )


def discount_effectiveness(t: Retail) -> DataFrame:
    return (
        t.sales.groupBy(discount_bucket(F.col("discount")).alias("discount_bucket"))
        .agg(
            F.count(F.lit(1)).alias("sales_count"),
            mean("quantity", 2).alias("avg_qty"),
            mean("total", 2).alias("avg_order_value"),
            mean("profit", 2).alias("avg_profit"),
            percent(F.sum("profit"), F.sum("total")).alias("overall_margin_pct"),
        )
        .orderBy("discount_bucket")
    )


def seasonality_dow(g: Gold) -> DataFrame:
    days = F.array(*[F.lit(d) for d in WEEKDAYS])
    return (
        g.daily_measures.groupBy("weekday")
        .agg(
            F.count(F.lit(1)).alias("data_points"),
            mean("total_revenue", 2).alias("avg_daily_revenue"),
            F.sum("total_revenue").alias("total_revenue"),
            mean("units_sold", 2).alias("avg_units"),
        )
        .orderBy(F.array_position(days, F.col("weekday")))
    )


def seasonality_monthly(g: Gold) -> DataFrame:
    return (
        g.monthly_time_series.groupBy("year", "month")
        .agg(F.sum("monthly_revenue").alias("revenue"), F.sum("monthly_units").alias("units"))
        .orderBy("year", "month")
    )


def anomaly_detection(g: Gold, limit: float = 2.5) -> DataFrame:
    """Store-days whose revenue lies far from their category's mean."""
    # Read twice, so computed once. The statistics are an aggregate joined back:
    # a window per category would hold a whole category in one task.
    daily = settle(g.daily_measures.select("sale_date", "category", "total_revenue"), "daily")
    value = F.col("total_revenue").cast("double")
    stats = daily.groupBy("category").agg(F.avg(value).alias("mu"), F.stddev(value).alias("sigma"))
    # Settled too: with its true size known, it is broadcast unless categories are too many,
    # and the days of a large category are not moved to one task.
    stats = settle(stats, "stats")
    z = F.round((value - F.col("mu")) / F.nullif(F.col("sigma"), F.lit(0.0)), 3)
    return (
        daily.join(stats, "category")
        .select("sale_date", "category", F.round("total_revenue", 2).alias("revenue"), z.alias("z_score"))
        .where(F.abs("z_score") > limit)
        .withColumn("flag", F.lit("ANOMALY"))
        .orderBy(F.desc(F.abs("z_score")))
    )


def employee_sums(t: Retail) -> DataFrame:
    """Employees with orders, and what those orders came to."""
    sums = (
        orders_with_sums(t)
        .groupBy("employee_id")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("revenue").alias("revenue"),
            F.sum("profit").alias("profit"),
            F.sum("lines").alias("lines"),
        )
    )
    people = t.employees.select("employee_id", "employee_name", "department", "salary")
    return people.join(sums, "employee_id")


def employee_performance(t: Retail) -> DataFrame:
    return t.once("employee_performance", lambda: _employee_performance(t))


def _employee_performance(t: Retail) -> DataFrame:
    ranked = GlobalOrder(employee_sums(t)).rank("revenue", "revenue_rank", "employee_id").df
    return ranked.select(
        "employee_id",
        "employee_name",
        "department",
        "salary",
        F.col("orders").alias("orders_handled"),
        F.round("revenue", 2).alias("revenue_generated"),
        quotient("revenue", "lines", 2).alias("avg_order_value"),
        F.round("profit", 2).alias("total_profit"),
        percent("profit", "revenue").alias("profit_margin_pct"),
        quotient("revenue", "salary", 4).alias("revenue_to_salary_ratio"),
        "revenue_rank",
    ).orderBy(F.desc("revenue_generated"))


def inventory_risk(t: Retail) -> DataFrame:
    """Days of cover per product sold, from its demand between first and last sale."""
    return t.once("inventory_risk", lambda: _inventory_risk(t))


def _inventory_risk(t: Retail) -> DataFrame:
    demand = (
        order_product_sums(t).join(t.order_heads.select("order_id", "order_date"), "order_id")
        .groupBy("product_id")
        .agg(
            F.sum("units").alias("total_sold"),
            F.count(F.lit(1)).alias("order_count"),
            F.datediff(F.max("order_date"), F.min("order_date")).alias("sales_days"),
        )
    )
    per_day = quotient("total_sold", F.greatest("sales_days", F.lit(1)), 3)
    # Demand has three decimals: thousandths keep the division exact.
    demanded = F.greatest(F.col("daily_demand") * 1000, F.lit(10))
    cover = F.col("days_of_cover")
    return (
        t.products.select("product_id", "product_name", "category", "stock")
        .join(demand, "product_id")
        .withColumn("daily_demand", per_day)
        .withColumn("days_of_cover", quotient(F.col("stock") * 1000, demanded, 0))
        .withColumn(
            "inventory_status", label([(cover < 30, "STOCKOUT RISK"), (cover > 365, "OVERSTOCKED")], "OK")
        )
        .orderBy("days_of_cover")
    )
