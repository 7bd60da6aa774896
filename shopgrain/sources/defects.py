"""Source tables with defects, made by rule from clean ones.

The cleaning jobs are verified on these: blank keys, spellings, unknown states,
amounts that do not add up, and second copies of customers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.sources.retail import Retail

# Spellings of countries that raw stores carry, by store number.
COUNTRY_SPELLINGS = ("usa", " UK ", "canada", "germany", "FRANCE", "australia", "Japan", "atlantis")
COPY_OFFSET = 1_000_000_000


def _when(key: str, every: int, at: int, value, column: str) -> Column:
    """``value`` in each ``every``-th row, else what ``column`` holds."""
    new = value if isinstance(value, Column) else F.lit(value)
    return F.when(F.col(key) % every == at, new).otherwise(F.col(column))


def _customers(t: Retail) -> DataFrame:
    first = t.customers.withColumns(
        {
            "email": _when("customer_id", 50, 7, None, "email"),
            "first_name": _when("customer_id", 61, 5, None, "first_name"),
            "city": F.concat(F.lit(" "), F.lower("city"), F.lit("  ")),
        }
    )
    copies = t.customers.withColumns(
        {
            "customer_id": F.col("customer_id") + COPY_OFFSET,
            "email": F.concat(F.lit(" "), F.upper("email")),
        }
    )
    return first.unionByName(copies)


def _products(t: Retail) -> DataFrame:
    free = F.lit(0).cast("decimal(18,2)")
    return t.products.withColumns(
        {
            "product_name": _when("product_id", 83, 2, None, "product_name"),
            "selling_price": _when("product_id", 71, 3, free, "selling_price"),
        }
    )


def _employees(t: Retail) -> DataFrame:
    low = F.lit(19999).cast("decimal(18,2)")
    return t.employees.withColumns(
        {
            "salary": _when("employee_id", 11, 6, low, "salary"),
            "employee_id": _when("employee_id", 9, 4, None, "employee_id"),
        }
    )


def _stores(t: Retail) -> DataFrame:
    spellings = F.array(*[F.lit(c) for c in COUNTRY_SPELLINGS])
    return t.stores.drop("region").withColumns(
        {
            "country": F.element_at(spellings, (F.col("store_id") % 8 + 1).cast("int")),
            "store_id": _when("store_id", 14, 13, None, "store_id"),
        }
    )


def _orders(t: Retail) -> DataFrame:
    return t.orders.withColumns(
        {
            "order_date": _when("order_id", 89, 1, None, "order_date"),
            "status": _when("order_id", 13, 6, "refunded", "status"),
        }
    )


def _sales(t: Retail) -> DataFrame:
    cent_more = (F.col("total") + F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")
    return t.sales.withColumns(
        {
            "quantity": _when("order_id", 101, 9, 0, "quantity"),
            "unit_price": _when("order_id", 103, 8, F.lit(-1).cast("decimal(18,6)"), "unit_price"),
            "total": _when("order_id", 47, 1, cent_more, "total"),
        }
    )


_MAKERS = {
    "customers": _customers,
    "products": _products,
    "employees": _employees,
    "stores": _stores,
    "orders": _orders,
    "sales": _sales,
}


def raw_table(t: Retail, name: str) -> DataFrame:
    return _MAKERS[name](t)
