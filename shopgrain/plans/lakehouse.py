"""The lakehouse analyses: gross line revenue, orders with a discount fraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.functions.columns import (
    FINE,
    as_of_date,
    label,
    mean,
    month_start,
    percent,
    quotient,
)
from shopgrain.operators.baskets import top_pairs
from shopgrain.operators.global_order import GlobalOrder
from shopgrain.operators.gold import with_gross
from shopgrain.operators.rollups import (
    day_category_sums,
    order_product_sums,
    order_sums,
    orders_with_sums,
    product_sums,
)
from shopgrain.plans.core import against_year_before, scored, share_class
from shopgrain.plans.extended import cohort_activity, employee_sums, value_distribution
from shopgrain.sources.retail import Retail


def sales_dashboard(t: Retail, as_of: str, months: int = 12) -> DataFrame:
    since = F.add_months(as_of_date(as_of), -months)
    return (
        day_category_sums(with_gross(t))
        .where(F.col("order_date") >= since)
        .groupBy(month_start("order_date").alias("month"), "category")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("profit").alias("profit"),
            F.sum("orders").alias("num_orders"),
        )
        .orderBy(F.desc("month"), F.desc("revenue"))
    )


def top_products(t: Retail, n: int = 20) -> DataFrame:
    named = product_sums(with_gross(t)).join(
        t.products.select("product_id", "product_name", "category"), "product_id"
    )
    # The first n rows hold the n highest ranks, so ranking those n is enough.
    top = named.orderBy(F.desc("revenue"), "product_id").limit(n)
    return top.select(
        "product_id",
        "product_name",
        "category",
        "revenue",
        "profit",
        quotient("unit_prices", "lines", 2, unit=FINE).alias("avg_unit_price"),
        F.col("units").alias("units_sold"),
        F.rank().over(Window.orderBy(F.desc("revenue"))).alias("revenue_rank"),
    )


def customer_values(t: Retail) -> DataFrame:
    return (
        orders_with_sums(with_gross(t))
        .groupBy("customer_id")
        .agg(
            F.sum("revenue").alias("lifetime_value"),
            F.count(F.lit(1)).alias("total_orders"),
            F.max("order_date").alias("last_order"),
        )
    )


def customer_segmentation(
    t: Retail, borders: tuple[int, int, int, int] = (5000, 2000, 500, 100)
) -> DataFrame:
    ltv = F.col("lifetime_value")
    names = ("Platinum", "Gold", "Silver", "Bronze")
    return (
        customer_values(t)
        .join(t.customers.select("customer_id", "first_name", "last_name", "country"), "customer_id")
        .select(
            "customer_id",
            F.concat_ws(" ", "first_name", "last_name").alias("full_name"),
            "country",
            "lifetime_value",
            "total_orders",
            label([(ltv >= b, n) for b, n in zip(borders, names)], "Standard").alias("segment"),
        )
        .orderBy(F.desc("lifetime_value"))
    )


def store_performance(t: Retail) -> DataFrame:
    sums = (
        orders_with_sums(with_gross(t), store=True)
        .groupBy("store_id")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("profit").alias("profit"),
            F.count(F.lit(1)).alias("num_orders"),
            mean("revenue", 2, count="lines").alias("avg_order_value"),
        )
    )
    named = t.stores.select("store_id", "store_name", "city", "country").join(sums, "store_id")
    return GlobalOrder(named).rank("revenue", "revenue_rank", "store_id").df.orderBy(F.desc("revenue"))


def _monthly(t: Retail) -> DataFrame:
    return (
        day_category_sums(with_gross(t))
        .groupBy(month_start("order_date").alias("month"), "category")
        .agg(F.sum("revenue").alias("revenue"))
    )


def mom_growth(t: Retail) -> DataFrame:
    previous = F.lag("revenue").over(Window.partitionBy("category").orderBy("month"))
    return (
        _monthly(t)
        .withColumn("prev_revenue", previous)
        .withColumn("mom_growth_pct", percent(F.col("revenue") - F.col("prev_revenue"), "prev_revenue"))
        .orderBy(F.desc("month"), "category")
    )


def ltv_distribution(t: Retail) -> DataFrame:
    return value_distribution(
        customer_values(t).select("lifetime_value"), "lifetime_value", "mean_ltv"
    ).drop("total_customers")


def rfm(t: Retail, as_of: str) -> DataFrame:
    """Quintiles where 1 is best, as in ``rfm_analysis``; segments from R and F."""
    who = ("customer_id", False)
    base = customer_values(t).select(
        "customer_id",
        F.datediff(as_of_date(as_of), "last_order").alias("recency_days"),
        F.col("total_orders").alias("frequency"),
        F.round("lifetime_value", 2).alias("monetary"),
    )
    scores = scored(
        base,
        [("recency_days", False), who],
        [("frequency", True), who],
        [("monetary", True), who],
    )
    r, f, m = F.col("r"), F.col("f"), F.col("m")
    segment = label(
        [
            ((r >= 4) & (f >= 4), "Champions"),
            ((r >= 3) & (f >= 3), "Loyal"),
            ((r >= 4) & (f < 3), "Recent"),
            ((r <= 2) & (f >= 3), "At Risk"),
            ((r <= 2) & (f <= 2), "Lost"),
            ((r >= 3) & (f <= 2), "Promising"),
        ],
        "Needs Attention",
    )
    return scores.select(
        "customer_id",
        "recency_days",
        "frequency",
        "monetary",
        r.alias("r_score"),
        f.alias("f_score"),
        m.alias("m_score"),
        F.concat(r, f, m).alias("rfm_score"),
        segment.alias("segment"),
    ).orderBy(F.desc("monetary"))


def cohort_retention(t: Retail) -> DataFrame:
    return (
        cohort_activity(t)
        .select(
            "cohort_month",
            "months_since",
            "customers",
            percent("customers", "cohort_size").alias("retention_pct"),
        )
        .orderBy("cohort_month", "months_since")
    )


def abc_products(t: Retail) -> DataFrame:
    named = product_sums(with_gross(t)).join(
        t.products.select("product_id", "product_name", "category"), "product_id"
    )
    ordered = GlobalOrder(named.select("product_id", "product_name", "category", "revenue"))
    total = ordered.total("revenue")
    running = ordered.running_sum("revenue", [F.desc("revenue"), F.col("product_id")], "running").df
    return running.select(
        "product_id",
        "product_name",
        "category",
        "revenue",
        percent("running", F.lit(total)).alias("cum_pct"),
        share_class("running", total).alias("abc_class"),
    ).orderBy(F.desc("revenue"))


def inventory_risk(t: Retail, as_of: str, days: int = 90) -> DataFrame:
    """Stock cover from the last days with sales; products without any come first."""
    since = F.date_sub(as_of_date(as_of), days)
    recent = t.order_heads.where(F.col("order_date") >= since).select("order_id", "order_date")
    per_day = (
        order_product_sums(t)
        .join(recent, "order_id")
        .groupBy("product_id", "order_date")
        .agg(F.sum("units").alias("units"))
    )
    sold = per_day.groupBy("product_id").agg(
        F.sum("units").alias("units"), F.count(F.lit(1)).alias("days")
    )
    # stock / (units / days), compared and divided without an intermediate rounding.
    stock_days, units = F.col("stock") * F.col("days"), F.col("units")
    return (
        t.products.select("product_id", "product_name", "category", "stock")
        .join(sold, "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "category",
            "stock",
            quotient("units", "days", 2).alias("avg_daily_units"),
            quotient(stock_days, "units", 1).alias("days_of_cover"),
            label(
                [(stock_days < 14 * units, "STOCKOUT_RISK"), (stock_days > 180 * units, "OVERSTOCKED")],
                "OK",
            ).alias("risk_flag"),
        )
        .orderBy(F.asc_nulls_first("days_of_cover"))
    )


def yoy(t: Retail) -> DataFrame:
    monthly = _monthly(t).select(
        F.year("month").alias("yr"), F.month("month").alias("mth"), "category",
        F.col("revenue").alias("current_year_rev"),
    )
    before = against_year_before(monthly, "yr", "mth", "current_year_rev")
    return (
        monthly.withColumn("prev_year_rev", before)
        .withColumn(
            "yoy_growth_pct", percent(F.col("current_year_rev") - F.col("prev_year_rev"), "prev_year_rev")
        )
        .orderBy(F.desc("yr"), "mth", "category")
    )


def orders_with_discount(t: Retail) -> DataFrame:
    """Orders with ``discount_pct``, the mean discount of their lines as a fraction."""
    sums = order_sums(t).select(
        "order_id", quotient("discounts", F.col("lines") * 100, 4).alias("discount_pct")
    )
    return t.orders.join(sums, "order_id", "left")


def discount_label(pct: Column) -> Column:
    return label(
        [(pct == 0, "No Discount"), (pct <= 0.10, "1-10%"), (pct <= 0.20, "11-20%"), (pct <= 0.30, "21-30%")],
        "31%+",
    )


def discount(t: Retail) -> DataFrame:
    """Order value and margin by the order's discount; the margin is a mean of line margins."""
    g = with_gross(t)
    per_order = (
        g.sales.withColumn("margin", quotient("profit", "total", 6, times=100))
        .groupBy("order_id")
        .agg(
            F.sum("total").alias("revenue"),
            F.sum("profit").alias("profit"),
            F.sum("margin").alias("margins"),
            F.count("margin").alias("margin_lines"),
            F.count(F.lit(1)).alias("lines"),
            quotient(F.sum("discount"), F.count(F.lit(1)) * 100, 4).alias("discount_pct"),
        )
        .join(g.order_heads.select("order_id"), "order_id", "left_semi")
    )
    return (
        per_order.groupBy(discount_label(F.col("discount_pct")).alias("discount_bucket"))
        .agg(
            F.count(F.lit(1)).alias("num_orders"),
            mean("revenue", 2, count="lines").alias("avg_order_value"),
            mean("margins", 2, count="margin_lines", unit=FINE).alias("avg_margin_pct"),
            F.sum("profit").alias("total_profit"),
        )
        .orderBy("discount_bucket")
    )


def employee(t: Retail) -> DataFrame:
    ranked = GlobalOrder(employee_sums(with_gross(t))).rank("revenue", "revenue_rank", "employee_id").df
    return ranked.select(
        "employee_id",
        F.col("employee_name").alias("full_name"),
        "department",
        "salary",
        F.col("orders").alias("orders_handled"),
        F.col("revenue").alias("revenue_generated"),
        F.col("profit").alias("profit_generated"),
        quotient("revenue", "salary", 2).alias("revenue_to_salary_ratio"),
        "revenue_rank",
    ).orderBy(F.desc("revenue_generated"))


def anomaly(t: Retail, limit: float = 2.5) -> DataFrame:
    """Category-days far from their category's mean.

    A category has one row per calendar day here, which bounds the window.
    """
    daily = (
        day_category_sums(with_gross(t))
        .groupBy("category", "order_date")
        .agg(F.sum("revenue").alias("revenue"))
    )
    value, per_category = F.col("revenue").cast("double"), Window.partitionBy("category")
    z = F.abs((value - F.col("mu")) / F.nullif(F.col("sigma"), F.lit(0.0)))
    return (
        daily.withColumn("mu", F.avg(value).over(per_category))
        .withColumn("mean_revenue", quotient(F.sum("revenue").over(per_category), F.count("revenue").over(per_category), 2))
        .withColumn("sigma", F.stddev(value).over(per_category))
        .where(z > limit)
        .select(
            "category",
            "order_date",
            "revenue",
            "mean_revenue",
            F.round("sigma", 2).alias("std_revenue"),
            F.round(z, 2).alias("z_score"),
            F.lit(True).alias("is_anomaly"),
        )
        .orderBy(F.desc("z_score"))
    )


def seasonality(t: Retail) -> DataFrame:
    """Weekday (1 = Monday) x month x category."""
    return (
        day_category_sums(with_gross(t))
        .groupBy(
            (F.weekday("order_date") + 1).alias("day_of_week"),
            F.month("order_date").alias("month_num"),
            "category",
        )
        .agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("num_orders"))
        .orderBy("month_num", "day_of_week", F.desc("revenue"))
    )


def cross_sell_pairs(t: Retail, n: int = 30) -> DataFrame:
    """Products most often bought together, by name and category."""
    top = top_pairs(t, n)

    def named(side: str) -> DataFrame:
        # An item is named by its lowest product, so the names are a key lookup.
        return t.products.select(
            F.col("product_id").alias(f"item_{side}"),
            F.col("product_name").alias(f"product_{side}"),
            F.col("category").alias(f"category_{side}"),
        )

    return (
        top.join(named("a"), "item_a")
        .join(named("b"), "item_b")
        .orderBy(F.desc("n"), "item_a", "item_b")
        .select("product_a", "product_b", "category_a", "category_b", F.col("n").alias("co_occurrences"))
    )
