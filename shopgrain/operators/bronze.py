"""Raw layer: audit columns and the rows that must not enter."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.sources.retail import TABLES

SOURCE_SYSTEM = "postgresql"
LAKE_SOURCE = "rds_postgresql"


def _moment(ingested_at: str | None) -> Column:
    return F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")


def add_audit_columns(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    return df.withColumns(
        {
            "ingestion_timestamp": _moment(ingested_at),
            "source_system": F.lit(SOURCE_SYSTEM),
            "data_version": F.lit(1),
        }
    )


# What a row needs to be kept: columns that must be present, and amounts above zero.
REQUIRED = {
    "customers": ("customer_id", "first_name", "email"),
    "products": ("product_id", "product_name"),
    "employees": ("employee_id",),
    "stores": ("store_id",),
    "orders": ("order_id", "order_date"),
    "sales": ("sale_id", "order_id", "product_id"),
}
POSITIVE = {"sales": ("quantity", "unit_price")}


def bronze(table: str, raw: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Admitted rows of one table. The filter sits on the source, where it is pushed down."""
    admitted = raw.dropna(subset=list(REQUIRED[table]))
    for amount in POSITIVE.get(table, ()):
        admitted = admitted.where(F.col(amount) > 0)
    return add_audit_columns(admitted, ingested_at)


def bronze_customers(raw: DataFrame, ingested_at: str | None = None) -> DataFrame:
    return bronze("customers", raw, ingested_at)


def bronze_products(raw: DataFrame, ingested_at: str | None = None) -> DataFrame:
    return bronze("products", raw, ingested_at)


def bronze_employees(raw: DataFrame, ingested_at: str | None = None) -> DataFrame:
    return bronze("employees", raw, ingested_at)


def bronze_stores(raw: DataFrame, ingested_at: str | None = None) -> DataFrame:
    return bronze("stores", raw, ingested_at)


def bronze_orders(raw: DataFrame, ingested_at: str | None = None) -> DataFrame:
    return bronze("orders", raw, ingested_at)


def bronze_sales(raw: DataFrame, ingested_at: str | None = None) -> DataFrame:
    return bronze("sales", raw, ingested_at)


def bronze_ingest_all(
    read: Callable[[str], DataFrame], ingested_at: str | None = None
) -> dict[str, DataFrame]:
    """All six tables, lazily; ``read`` opens a source table by name."""
    return {name: bronze(name, read(name), ingested_at) for name in TABLES}


def bronze_generic(raw: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """The lakehouse form: every row enters, with two stamps."""
    return raw.withColumns({"__ingested_at": _moment(ingested_at), "__source": F.lit(LAKE_SOURCE)})


def data_quality(df: DataFrame) -> DataFrame:
    """One row: record count, nulls per column, row groups that occur twice or more.

    Nulls are counted where rows are read. For copies, two hashes of each row are
    grouped; only rows whose hashes repeat are moved and compared as a whole.
    """
    columns, one = df.columns, F.lit(1)
    counted = df.agg(
        F.count(one).alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns],
        F.lit(0).cast("long").alias("duplicates"),
    )
    marks = {"__mark_a": F.xxhash64(*columns), "__mark_b": F.xxhash64(F.lit(7), *columns)}
    marked = df.withColumns(marks)
    repeated = marked.groupBy(*marks).agg(F.count(one).alias("__n")).where("__n > 1").select(*marks)
    groups = marked.join(repeated, [*marks], "left_semi").groupBy(*columns).agg(F.count(one).alias("__n"))
    zero = F.lit(0).cast("long")
    found = groups.agg(
        zero.alias("total_records"),
        *[zero.alias(f"nulls_{c}") for c in columns],
        F.count_if(F.col("__n") > 1).alias("duplicates"),
    )
    both = counted.unionByName(found)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns]).withColumn(
        "schema", F.lit(df.schema.simpleString())
    )
