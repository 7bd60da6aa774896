"""Views and catalog tables over layer folders."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# Columns and types of the declared lakehouse tables.
LAKE_SCHEMAS = {
    "customers": (
        "customer_id int, first_name string, last_name string, email string, phone string,"
        " city string, country string, gender string, join_date date, updated_at timestamp"
    ),
    "products": (
        "product_id int, product_name string, category string, selling_price double,"
        " cost_price double, profit_margin double, stock int, updated_at timestamp"
    ),
    "employees": (
        "employee_id int, first_name string, last_name string, department string, salary double,"
        " hire_date date, store_id int, updated_at timestamp"
    ),
    "stores": (
        "store_id int, store_name string, city string, country string, region string,"
        " updated_at timestamp"
    ),
    "orders": (
        "order_id int, customer_id int, store_id int, employee_id int, order_date date,"
        " status string, discount_pct double, updated_at timestamp"
    ),
    "sales": (
        "sale_id int, order_id int, product_id int, quantity int, unit_price double,"
        " total_revenue double, profit double, updated_at timestamp"
    ),
}
DATABASES = ("raw", "clean", "curated", "cdc")


def register_views(
    read: Callable[[str], DataFrame], tables: Iterable[str], prefix: str = ""
) -> list[str]:
    """A temporary view per table that can be opened; the others are logged and left out."""
    registered = []
    for table in tables:
        try:
            read(table).createOrReplaceTempView(f"{prefix}{table}")
            registered.append(f"{prefix}{table}")
        except Exception as error:
            log.warning("no view %s%s: %s", prefix, table, error)
    return registered


def create_databases(spark: SparkSession, prefix: str, names: Iterable[str] = DATABASES) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}_{name}")


def register_tables(
    spark: SparkSession,
    database: str,
    location: Callable[[str], str],
    schemas: Mapping[str, str] = LAKE_SCHEMAS,
    partitioned_by: tuple[str, ...] = (),
) -> list[str]:
    """External Parquet tables with declared columns over existing folders."""
    clause = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    for table, columns in schemas.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet{clause}"
            f" LOCATION '{location(table)}'"
        )
    return [f"{database}.{t}" for t in schemas]


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Make folders written since the last look part of the table."""
    spark.sql(f"MSCK REPAIR TABLE {table}")
