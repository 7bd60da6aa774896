"""Partial sums the analyses share.

Sale lines are summed to their order (or product) before anything is joined:
an order or product with a third of all lines shrinks to one row inside the map
tasks, and later counts of distinct orders become plain counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.sources.retail import Retail

_SUMS = {
    "revenue": "total",
    "profit": "profit",
    "units": "quantity",
    "discounts": "discount",
    "unit_prices": "unit_price",
}


def _line_sums() -> list:
    return [F.sum(source).alias(name) for name, source in _SUMS.items()] + [
        F.count(F.lit(1)).alias("lines")
    ]


def sums_again(*names: str) -> list:
    """The same sums one level up."""
    return [F.sum(n).alias(n) for n in (names or (*_SUMS, "lines"))]


def order_sums(t: Retail) -> DataFrame:
    """One row per order that has sales."""
    return t.once("order_sums", lambda: t.sales.groupBy("order_id").agg(*_line_sums()))


def orders_with_sums(t: Retail, store: bool = False) -> DataFrame:
    """Orders joined one to one with the sums of their lines."""
    name, orders = ("store_orders", "orders") if store else ("orders", "order_heads")
    return t.once(f"{name}_with_sums", lambda: getattr(t, orders).join(order_sums(t), "order_id"))


def product_sums(t: Retail) -> DataFrame:
    return t.once("product_sums", lambda: t.sales.groupBy("product_id").agg(*_line_sums()))


def order_product_sums(t: Retail) -> DataFrame:
    """One row per order and product: units, revenue, lines."""
    return t.once(
        "order_product_sums",
        lambda: t.sales.groupBy("order_id", "product_id").agg(
            F.sum("quantity").alias("units"), F.sum("total").alias("revenue"), F.count(F.lit(1)).alias("lines")
        ),
    )


def order_category_sums(t: Retail) -> DataFrame:
    """One row per order and category, spread by order; an order counts once in each of its categories.

    Lines are spread by order and product first, so an order with a third of all lines
    meets in one task only after it is one row per product.
    """
    return t.once("order_category_sums", lambda: _order_category_sums(t))


def _order_category_sums(t: Retail) -> DataFrame:
    lines = t.sales.join(t.products.select("product_id", "category"), "product_id")
    per_product = (
        t.spread(lines, "order_id", "product_id")
        .groupBy("order_id", "product_id", "category")
        .agg(*_line_sums())
    )
    kinds = dict(per_product.dtypes)
    sums = t.spread(per_product, "order_id").groupBy("order_id", "category").agg(*sums_again())
    return sums.select("order_id", "category", *[F.col(n).cast(kinds[n]) for n in (*_SUMS, "lines")])


def with_orders(t: Retail, sums: DataFrame, orders: DataFrame) -> DataFrame:
    """``sums`` spread by order, joined to the orders where they lie."""
    return sums.join(t.spread(orders, "order_id"), "order_id")


def dated_category_sums(t: Retail) -> DataFrame:
    """Order, category and order date with the sums of the lines between them."""
    return with_orders(t, order_category_sums(t), t.order_heads.select("order_id", "order_date"))


def day_category_sums(t: Retail) -> DataFrame:
    """Revenue, profit and lines of each day and category, and how many orders they come from."""
    return t.once(
        "day_category_sums",
        lambda: dated_category_sums(t)
        .groupBy("order_date", "category")
        .agg(*sums_again("revenue", "profit", "lines"), F.count(F.lit(1)).alias("orders")),
    )
