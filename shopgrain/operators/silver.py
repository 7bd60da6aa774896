"""Cleaned layer: one function per table, and one that fits any table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.functions.columns import label, percent, quotient
from shopgrain.sources.retail import KEYS

# Names, borders and the address pattern of the cleaned tables.
CATEGORIES = {
    "Electronics": "Electronics",
    "Clothing": "Apparel",
    "Books": "Books",
    "Furniture": "Furniture",
    "Sports": "Sports",
    "Food": "Food",
}
REGIONS = {
    "Usa": "North America",
    "Canada": "North America",
    "Uk": "Europe",
    "Germany": "Europe",
    "France": "Europe",
    "Australia": "Oceania",
    "Japan": "Asia",
}
STATUSES = ("Completed", "Pending", "Cancelled", "Shipped")
PRICE_TIERS = ("Budget", "Mid-Range", "Premium")
GENDERS = ("Male", "Female")
EMAIL = r"^[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}$"


@dataclass(frozen=True)
class Borders:
    """Upper borders of the tiers; a value on the border belongs to the next tier."""

    price: tuple[int, int] = (100, 300)
    salary: tuple[int, int, int] = (50000, 80000, 120000)
    sale: tuple[int, int] = (100, 500)
    valid_salary: tuple[int, int] = (20000, 200000)


def _processed(df: DataFrame, at: str | None) -> DataFrame:
    stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return df.withColumn("processed_timestamp", stamp)


def _lookup(c: str | Column, names: Mapping[str, str], otherwise: str) -> Column:
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    key = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.create_map(*pairs)[key], F.lit(otherwise))


def _tier(value: str, borders: Sequence[int], names: Sequence[str]) -> Column:
    return label([(F.col(value) < b, n) for b, n in zip(borders, names)], names[-1])


def keep_one(df: DataFrame, keys: Sequence[str], first: Column, latest: bool = False) -> DataFrame:
    """One row per key: the lowest ``first``, or the highest when ``latest``.

    Taken as an aggregate, not a window: a key with a third of the rows is
    reduced inside the map tasks. Equal ``first`` values are settled by the other
    columns, so the choice does not depend on row order.
    """
    pick = F.max if latest else F.min
    row = F.struct(first.alias("__first"), F.struct(*df.columns).alias("__row"))
    return df.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(
        pick(row)["__row"].alias("__row")
    ).select("__row.*")


def dedupe_first(df: DataFrame, key: str = "email", order: str = "customer_id") -> DataFrame:
    """The row with the lowest ``order`` of each ``key``."""
    return keep_one(df, [key], F.col(order))


def silver_customers(bronze: DataFrame, processed_at: str | None = None) -> DataFrame:
    # Addresses are normalised before duplicates are sought, so that spellings
    # of one address meet.
    normal = bronze.withColumn("email", F.lower(F.trim("email")))
    cleaned = dedupe_first(normal).withColumns(
        {
            "first_name": F.upper(F.trim("first_name")),
            "last_name": F.upper(F.trim("last_name")),
            "city": F.initcap(F.trim("city")),
            "country": F.initcap(F.trim("country")),
            "gender": F.when(F.col("gender").isin(*GENDERS), F.col("gender")).otherwise("Unknown"),
            "email_valid": F.col("email").rlike(EMAIL),
        }
    )
    return _processed(cleaned, processed_at)


def catalogue_columns(borders: Borders = Borders()) -> dict[str, Column]:
    """Margin and price tier of a product at its list price."""
    return {
        "profit_margin": percent(F.col("selling_price") - F.col("cost_price"), "selling_price"),
        "price_tier": _tier("selling_price", borders.price, PRICE_TIERS),
    }


def silver_products(
    bronze: DataFrame,
    processed_at: str | None = None,
    categories: Mapping[str, str] = CATEGORIES,
    borders: Borders = Borders(),
) -> DataFrame:
    cleaned = bronze.withColumns(
        {
            "category": _lookup("category", categories, "Unknown"),
            "stock_value": F.col("stock") * F.col("cost_price"),
            **catalogue_columns(borders),
        }
    )
    return _processed(cleaned, processed_at)


def silver_employees(
    bronze: DataFrame, processed_at: str | None = None, borders: Borders = Borders()
) -> DataFrame:
    cleaned = bronze.withColumns(
        {
            "salary_valid": F.coalesce(F.col("salary").between(*borders.valid_salary), F.lit(False)),
            "salary_tier": _tier("salary", borders.salary, ("Entry", "Mid", "Senior", "Executive")),
        }
    )
    return _processed(cleaned, processed_at)


def silver_stores(
    bronze: DataFrame, processed_at: str | None = None, regions: Mapping[str, str] = REGIONS
) -> DataFrame:
    country = F.initcap(F.trim("country"))
    cleaned = bronze.withColumns(
        {
            "city": F.initcap(F.trim("city")),
            "country": country,
            "region": _lookup(country, regions, "Other"),
        }
    )
    return _processed(cleaned, processed_at)


def silver_orders(bronze: DataFrame, processed_at: str | None = None) -> DataFrame:
    known = F.col("status").isin(*STATUSES)
    cleaned = bronze.withColumns(
        {
            "status": F.when(known, F.col("status")).otherwise("Unknown"),
            "order_year": F.year("order_date"),
            "order_month": F.month("order_date"),
            "order_day": F.dayofmonth("order_date"),
            "order_quarter": F.quarter("order_date"),
            "order_weekday": F.dayofweek("order_date"),
            "order_week": F.weekofyear("order_date"),
        }
    )
    return _processed(cleaned, processed_at)


def silver_sales(
    bronze: DataFrame, processed_at: str | None = None, borders: Borders = Borders()
) -> DataFrame:
    gross = F.col("quantity") * F.col("unit_price")
    cent = F.lit("0.01").cast("decimal(3,2)")
    net = F.round(gross * (100 - F.col("discount")) * cent, 2)
    cleaned = bronze.withColumns(
        {
            "total_valid": F.round("total", 2) == net,
            "profit_valid": F.col("profit") >= 0,
            "discount_amount": F.round(gross * F.col("discount") * cent, 6),
            "revenue_per_unit": quotient("total", "quantity", 6),
            "profit_margin": percent("profit", "total"),
            "sales_tier": _tier("total", borders.sale, ("Small", "Medium", "Large")),
        }
    )
    return _processed(cleaned, processed_at)


CLEANERS: dict[str, Callable[..., DataFrame]] = {
    "customers": silver_customers,
    "products": silver_products,
    "employees": silver_employees,
    "stores": silver_stores,
    "orders": silver_orders,
    "sales": silver_sales,
}


def silver_process_all(
    read: Callable[[str], DataFrame],
    processed_at: str | None = None,
    options: Mapping[str, dict] | None = None,
) -> dict[str, DataFrame]:
    """All six tables, lazily; ``read`` opens a raw-layer table by name.

    ``options`` holds a table's own maps or borders, by table name.
    """
    return {
        name: clean(read(name), processed_at, **(options or {}).get(name, {}))
        for name, clean in CLEANERS.items()
    }


def silver_generic(table: str, raw: DataFrame, processed_at: str | None = None) -> DataFrame:
    """Any table: latest row per key, trimmed strings, layer stamps."""
    key = KEYS[table]
    latest = keep_one(raw.dropna(subset=[key]), [key], F.col("__ingested_at"), latest=True)

    def clean(field: T.StructField) -> Column:
        if not isinstance(field.dataType, T.StringType):
            return F.col(field.name)
        text = F.trim(field.name)
        return (F.lower(text) if field.name == "email" else text).alias(field.name)

    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")
    return latest.select(*[clean(f) for f in latest.schema.fields]).withColumns(
        {"__silver_processed_at": stamp, "__layer": F.lit("silver")}
    )
