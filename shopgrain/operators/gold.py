"""Gold tables: one function per table, over cleaned tables.

Money stays decimal, so that sums do not depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.functions.columns import (
    as_of_date,
    col,
    label,
    mean,
    month_start,
    percent,
    quotient,
)
from shopgrain.operators.global_order import GlobalOrder
from shopgrain.operators.rollups import (
    day_category_sums,
    order_category_sums,
    orders_with_sums,
    product_sums,
    sums_again,
    with_orders,
)
from shopgrain.sources.retail import Retail
from shopgrain.sources.scratch import settle

YEAR_DAYS = 365


@dataclass(frozen=True)
class CustomerRules:
    """Where segments and churn risk begin. The defaults are this package's choice."""

    vip: int = 10000
    high: int = 5000
    medium: int = 1000
    churn_high_days: int = 180
    churn_medium_days: int = 90


DAY_KEYS = ("order_date", "category", "store_head")


def _store_heads(t: Retail) -> DataFrame:
    """store_id, and the lowest id of the stores with its name, city and country; with these names."""
    names = {"store_name": "store_name", "city": "store_city", "country": "store_country"}
    named = t.stores.select("store_id", *[F.col(c).alias(n) for c, n in names.items()])
    place = F.struct(*names.values())
    heads = named.groupBy(place.alias("place")).agg(F.min("store_id").alias("store_head"))
    return named.withColumn("__place", place).join(heads, F.col("__place").eqNullSafe(F.col("place"))).drop("__place", "place")


def _day_rows(t: Retail) -> DataFrame:
    """One row per order and category, with its day and the head of its store.

    Stores go by number until the sums are made, so names are not shuffled with rows.
    """
    orders = t.orders.select("order_id", "customer_id", "store_id", "order_date")
    # Settled, so that Spark knows how few they are: else all rows go by store, to a task for each.
    heads = settle(_store_heads(t).select("store_id", "store_head"), "heads")
    return with_orders(t, order_category_sums(t), orders).join(heads, "store_id")


def _with_store_names(t: Retail, sums: DataFrame) -> DataFrame:
    heads = _store_heads(t).where("store_id = store_head").drop("store_id")
    return sums.join(heads, "store_head")


def _day_columns(sums: DataFrame, *more: Column) -> DataFrame:
    return sums.select(
        F.col("order_date").alias("sale_date"),
        "category",
        "store_name",
        "store_city",
        "store_country",
        F.col("units").alias("units_sold"),
        F.col("revenue").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        F.round(F.col("unit_prices") / F.col("lines"), 6).alias("avg_unit_price"),
        F.col("orders").alias("order_count"),
        *more,
        quotient("discounts", "lines", 6).alias("avg_discount"),
        percent("profit", "revenue").alias("profit_margin"),
        F.year("order_date").alias("year"),
        F.month("order_date").alias("month"),
        F.dayofmonth("order_date").alias("day"),
        F.quarter("order_date").alias("quarter"),
        F.date_format("order_date", "EEEE").alias("weekday"),
    )


def daily_measures(t: Retail) -> DataFrame:
    """Day x category x store, without the count of customers and the shuffle it takes."""
    sums = _day_rows(t).groupBy(*DAY_KEYS).agg(*sums_again(), F.count(F.lit(1)).alias("orders"))
    return _day_columns(_with_store_names(t, sums))


def daily_sales_summary(t: Retail) -> DataFrame:
    """Day x category x store."""
    # Customers are made distinct by grouping, in the same pass as the sums.
    per_customer = _day_rows(t).groupBy(*DAY_KEYS, "customer_id").agg(
        *sums_again(), F.count(F.lit(1)).alias("orders")
    )
    sums = per_customer.groupBy(*DAY_KEYS).agg(
        *sums_again(), F.sum("orders").alias("orders"), F.count("customer_id").alias("customers")
    )
    return _day_columns(_with_store_names(t, sums), F.col("customers").alias("unique_customers"))


def customer_analytics(t: Retail, as_of: str, rules: CustomerRules = CustomerRules()) -> DataFrame:
    """Customers with at least one sale."""
    today = as_of_date(as_of)
    bought = (
        orders_with_sums(t)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("revenue").alias("lifetime_value"),
            mean("revenue", 6, count="lines").alias("avg_order_value"),
            F.max("order_date").alias("last_order_date"),
            F.min("order_date").alias("first_order_date"),
            F.sum("units").alias("total_products_purchased"),
            mean("discounts", 6, count="lines").alias("avg_discount_received"),
        )
    )
    ltv, idle = F.col("lifetime_value"), F.col("days_since_last_order")
    return (
        t.customers.join(bought, "customer_id")
        .withColumn("days_since_last_order", F.datediff(today, "last_order_date"))
        .withColumn("customer_tenure_days", F.datediff(today, "first_order_date"))
        .withColumn(
            "order_frequency",
            F.col("customer_tenure_days").cast("double") / F.col("total_orders").cast("double"),
        )
        .withColumn(
            "customer_segment",
            label(
                [
                    (ltv >= rules.vip, "VIP"),
                    (ltv >= rules.high, "High Value"),
                    (ltv >= rules.medium, "Medium Value"),
                ],
                "Low Value",
            ),
        )
        .withColumn(
            "churn_risk",
            label(
                [(idle > rules.churn_high_days, "High"), (idle > rules.churn_medium_days, "Medium")],
                "Low",
            ),
        )
        .withColumn("analytics_date", today)
    )


def product_measures(t: Retail) -> DataFrame:
    """Products with at least one sale and what they sold."""
    sums = product_sums(t).select(
        "product_id",
        F.col("units").alias("total_units_sold"),
        F.col("revenue").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        F.col("lines").alias("transaction_count"),
        F.round(F.col("unit_prices") / F.col("lines"), 6).alias("avg_selling_price"),
        quotient("discounts", "lines", 6).alias("avg_discount"),
        quotient("revenue", "units", 6).alias("revenue_per_unit"),
        # The margin of the sales replaces the catalogue margin.
        percent("profit", "revenue").alias("profit_margin"),
    )
    turnover = F.col("stock").cast("double") / F.nullif(F.col("total_units_sold"), F.lit(0)) * YEAR_DAYS
    sold = t.products.drop("profit_margin").join(sums, "product_id")
    return sold.withColumn("inventory_turnover_days", turnover)


def product_performance(t: Retail) -> DataFrame:
    """The measures with ranks by revenue and by profit."""
    ranked = (
        GlobalOrder(product_measures(t))
        .rank("total_revenue", "revenue_rank", "product_id")
        .rank("total_profit", "profit_rank", "product_id")
    )
    return ranked.df.withColumn(
        "performance_score", (F.col("revenue_rank") + F.col("profit_rank")) / 2.0
    )


def store_measures(t: Retail) -> DataFrame:
    """Stores with at least one sale."""
    per_customer = (
        orders_with_sums(t, store=True)
        .groupBy("store_id", "customer_id")
        .agg(*sums_again(), F.count(F.lit(1)).alias("orders"))
    )
    sums = per_customer.groupBy("store_id").agg(
        *sums_again(), F.sum("orders").alias("total_orders"), F.count("customer_id").alias("unique_customers")
    )
    measures = sums.select(
        "store_id",
        "total_orders",
        "unique_customers",
        F.col("units").alias("units_sold"),
        F.col("revenue").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        quotient("revenue", "lines", 6).alias("avg_order_value"),
        quotient("discounts", "lines", 6).alias("avg_discount"),
        quotient("revenue", "unique_customers", 6).alias("revenue_per_customer"),
        (F.col("total_orders").cast("double") / float(YEAR_DAYS)).alias("orders_per_day"),
        percent("profit", "revenue").alias("profit_margin"),
    )
    return t.stores.join(measures, "store_id")


def store_performance(t: Retail) -> DataFrame:
    """The measures with ranks by revenue."""
    return GlobalOrder(store_measures(t)).rank("total_revenue", "revenue_rank", "store_id").df


def monthly_time_series(daily: DataFrame) -> DataFrame:
    """Month x category with the change against the month before."""
    monthly = daily.groupBy("year", "month", "category").agg(
        F.sum("total_revenue").alias("monthly_revenue"),
        F.sum("units_sold").alias("monthly_units"),
        F.sum("order_count").alias("monthly_orders"),
        mean("total_revenue", 6).alias("avg_daily_revenue"),
    )
    # A category has one row per month, so the window stays small.
    previous = F.lag("monthly_revenue").over(Window.partitionBy("category").orderBy("year", "month"))
    return monthly.withColumn("prev_month_revenue", previous).withColumn(
        "mom_growth_pct",
        percent(F.col("monthly_revenue") - F.col("prev_month_revenue"), "prev_month_revenue"),
    )


@dataclass(frozen=True)
class Gold:
    """The gold tables of one set of cleaned tables, built when first used."""

    retail: Retail
    as_of: str
    rules: CustomerRules = CustomerRules()

    @cached_property
    def daily_sales_summary(self) -> DataFrame:
        return daily_sales_summary(self.retail)

    @cached_property
    def daily_measures(self) -> DataFrame:
        """The daily table for those who do not need its count of customers."""
        return daily_measures(self.retail)

    @cached_property
    def customer_analytics(self) -> DataFrame:
        return customer_analytics(self.retail, self.as_of, self.rules)

    @cached_property
    def product_measures(self) -> DataFrame:
        return product_measures(self.retail)

    @cached_property
    def product_performance(self) -> DataFrame:
        return product_performance(self.retail)

    @cached_property
    def store_measures(self) -> DataFrame:
        return store_measures(self.retail)

    @cached_property
    def store_performance(self) -> DataFrame:
        return store_performance(self.retail)

    @cached_property
    def monthly_time_series(self) -> DataFrame:
        return monthly_time_series(self.daily_measures)


GOLD_TABLES = (
    "daily_sales_summary",
    "customer_analytics",
    "product_performance",
    "store_performance",
    "monthly_time_series",
)


# -- the lakehouse form: gross line revenue, and counts of lines ------------


def line_revenue(quantity: str | Column = "quantity", price: str | Column = "unit_price") -> Column:
    """Quantity times price before discount, in cents."""
    return F.round(col(quantity) * col(price), 2).cast("decimal(18,2)")


def with_gross(t: Retail) -> Retail:
    """The lakehouse naming: ``total`` of a line is its gross revenue."""
    sales = t.sales.withColumn("net_total", F.col("total")).withColumn("total", line_revenue())
    return GrossRetail(t, sales)


class GrossRetail(Retail):
    """Another retail's tables with its own sales."""

    def __init__(self, base: Retail, sales: DataFrame):
        self._base, self.sales = base, sales

    def __getattr__(self, name: str):
        return getattr(self._base, name)

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self._base.once(f"gross_{name}", build)


def gold_monthly_revenue_by_category(t: Retail) -> DataFrame:
    g = with_gross(t)
    return day_category_sums(g).groupBy(month_start("order_date").alias("month"), "category").agg(
        F.round(F.sum("revenue"), 2).alias("total_revenue"),
        F.round(F.sum("profit"), 2).alias("total_profit"),
        F.sum("lines").alias("num_sales"),
    )


def gold_customer_ltv(t: Retail) -> DataFrame:
    g = with_gross(t)
    ltv = (
        orders_with_sums(g)
        .groupBy("customer_id")
        .agg(
            F.sum("revenue").alias("lifetime_value"),
            F.sum("lines").alias("total_orders"),
            mean("revenue", 2, count="lines").alias("avg_order_value"),
        )
    )
    return ltv.join(
        g.customers.select("customer_id", "first_name", "last_name", "city", "country"), "customer_id"
    )


def gold_product_perf(t: Retail) -> DataFrame:
    g = with_gross(t)
    sums = product_sums(g).select(
        "product_id",
        "revenue",
        "profit",
        percent("profit", "revenue").alias("margin_pct"),
        F.col("lines").alias("units_sold"),
    )
    return sums.join(g.products.select("product_id", "product_name", "category"), "product_id")


def gold_store_perf(t: Retail) -> DataFrame:
    g = with_gross(t)
    sums = (
        orders_with_sums(g, store=True)
        .groupBy("store_id")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("lines").alias("num_orders"),
            mean("revenue", 2, count="lines").alias("avg_order_value"),
        )
    )
    return sums.join(g.stores.select("store_id", "store_name", "city", "country"), "store_id")


def gold_employee_performance(t: Retail) -> DataFrame:
    g = with_gross(t)
    sums = (
        orders_with_sums(g)
        .groupBy("employee_id")
        .agg(
            F.sum("revenue").alias("revenue_handled"),
            F.sum("lines").alias("orders_handled"),
            F.sum("profit").alias("profit_generated"),
        )
    )
    return sums.join(g.employees.select("employee_id", "employee_name", "department"), "employee_id")
