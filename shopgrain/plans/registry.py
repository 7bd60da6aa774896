"""Every query by name, over a folder of star-schema Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.functions.columns import present
from shopgrain.operators import bronze, silver
from shopgrain.operators.gold import GOLD_TABLES, Gold
from shopgrain.plans import features, reports, storage_queries
from shopgrain.plans.analyses import ANALYSES, run_all, run_named
from shopgrain.plans.medallion import Medallion
from shopgrain.plans.model_queries import ModelQueries
from shopgrain.plans.storage_queries import AS_OF, RULES
from shopgrain.sources.defects import raw_table
from shopgrain.sources.retail import TABLES, from_star_schema
from shopgrain.sources.scratch import shared_folder

STAMP = "2001-08-02 06:00:00"

# Report parameters that lie inside the test tables' dates.
SINCE, YEAR = "2001-01-01", 2000
TIERS = (3_000_000, 2_200_000, 1_600_000, 1_200_000)
LTV_BORDERS = (1_000_000, 1_500_000, 2_000_000, 3_000_000)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _lists_as_text(df: DataFrame) -> DataFrame:
    """Array columns joined to text, which every engine compares alike."""
    return df.select(
        *[
            F.array_join(n, ", ").alias(n) if kind == "array<string>" else F.col(n)
            for n, kind in df.dtypes
        ]
    )


def _stamps_as_local(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the Parquet inputs carry them."""
    return df.select(
        *[
            F.col(n).cast("timestamp_ntz").alias(n) if kind == "timestamp" else F.col(n)
            for n, kind in df.dtypes
        ]
    )


def _on_raw(table: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: _stamps_as_local(
        present(build(raw_table(from_star_schema(spark, folder), table)))
    )


def _bronze(table: str) -> Query:
    return _on_raw(table, lambda raw: bronze.bronze(table, raw, STAMP))


def _silver(table: str, **options) -> Query:
    return _on_raw(
        table, lambda raw: silver.CLEANERS[table](bronze.bronze(table, raw, STAMP), STAMP, **options)
    )


# The star schema's part types, under the names its cleaned products carry.
PART_TYPES = {t.upper(): t for t in ("Economy", "Large", "Medium", "Promo", "Small")}

QUERIES |= {
    "add_audit_columns": lambda spark, folder: _stamps_as_local(
        bronze.add_audit_columns(from_star_schema(spark, folder).stores, STAMP)
    ),
    **{f"bronze_{t}": _bronze(t) for t in TABLES},
    "bronze_generic": _on_raw("orders", lambda raw: bronze.bronze_generic(raw, STAMP)),
    "data_quality": _on_raw("customers", bronze.data_quality),
    "dedupe_first": _on_raw(
        "customers",
        lambda raw: silver.dedupe_first(
            raw.dropna(subset=["first_name", "email"]).withColumn("email", F.lower(F.trim("email")))
        ),
    ),
    **{f"silver_{t}": _silver(t) for t in TABLES if t != "products"},
    "silver_products": _silver("products", categories=PART_TYPES),
    "silver_generic": _on_raw(
        "orders",
        lambda raw: silver.silver_generic(
            "orders",
            bronze.bronze_generic(raw, "2001-08-01 06:00:00")
            .withColumn("status", F.lit("outdated"))
            .unionByName(
                bronze.bronze_generic(raw, STAMP).withColumn("status", F.concat(F.lit(" "), "status"))
            ),
            STAMP,
        ),
    ),
}



def _as_cells(wide: DataFrame) -> DataFrame:
    """A pivot whose headings depend on the data, one row per cell."""
    return wide.unpivot([wide.columns[0]], wide.columns[1:], "store_country", "revenue")


CATEGORIES = (*sorted(PART_TYPES), "STANDARD")
ARGUMENTS = {
    "sales_dashboard_daily": (SINCE,),
    "mom_growth_year": (YEAR,),
    "ltv_buckets": (LTV_BORDERS,),
    "ath_customer_segmentation": (TIERS,),
    "pivot_revenue_month_category": (CATEGORIES,),
}


def _gold(spark: SparkSession, folder: str) -> Gold:
    return Gold(from_star_schema(spark, folder), AS_OF, RULES)


def _analysis(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = run_named(name, _gold(spark, folder), *ARGUMENTS.get(name, ()))
        return present(_lists_as_text(_as_cells(result) if name == "pivot_country" else result))

    return run


QUERIES |= {name: _analysis(name) for name in ANALYSES}

QUERIES |= {
    name: storage_queries.on_folder(build) for name, build in storage_queries.QUERIES.items()
}


def _run_all(spark: SparkSession, folder: str) -> DataFrame:
    """All analyses, each executed: its name and how many rows it gave; null if it failed."""
    results, failed = run_all(_gold(spark, folder), arguments=ARGUMENTS)
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in results.items()
    ]
    lost = spark.createDataFrame([(name, None) for name in failed], "name string, n long")
    return reduce(DataFrame.unionByName, counts, lost)


def _content(layer: str, table: str, df: DataFrame, without: tuple[str, ...] = ()) -> DataFrame:
    """Per column of a table: its filled cells, and a sum over the md5 of each, whatever the order of rows."""
    df = _stamps_as_local(present(df.drop(*without)))
    sums = []
    for name, kind in df.dtypes:
        text = F.round(F.col(name) * 1_000_000).cast("long") if kind == "double" else F.col(name)
        part = F.conv(F.substring(F.md5(text.cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
        sums.append(
            F.struct(F.lit(name).alias("column_name"), F.count(name).alias("filled"), F.sum(part).alias("checksum"))
        )
    return (
        df.agg(F.array(*sums).alias("columns"))
        .select(F.explode("columns").alias("c"))
        .select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "c.*")
        .where("filled > 0")
    )


def _run_layers(spark: SparkSession, folder: str) -> DataFrame:
    """Raw, cleaned and gold tables written from sources with defects: what they hold."""
    source = from_star_schema(spark, folder)
    root = f"{shared_folder(spark)}/queries/layers-{uuid.uuid4().hex}"
    lake = Medallion(
        spark,
        root,
        lambda name: raw_table(source, name),
        AS_OF,
        cleaning={"products": {"categories": PART_TYPES}},
        rules=RULES,
    )
    for step in ("bronze", "silver", "gold"):
        lake.run(step)
    stamps = ("ingestion_timestamp", "processed_timestamp")  # the time of the run
    held = [(layer, t) for layer in ("bronze", "silver") for t in TABLES] + [("gold", t) for t in GOLD_TABLES]
    return reduce(DataFrame.unionByName, [_content(layer, t, lake.table(layer, t), stamps) for layer, t in held])


def _bronze_all(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    source = from_star_schema(spark, folder)
    return bronze.bronze_ingest_all(lambda name: raw_table(source, name), STAMP)


def _ingest_all(spark: SparkSession, folder: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [_content("bronze", n, df) for n, df in _bronze_all(spark, folder).items()])


def _process_all(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = silver.silver_process_all(
        _bronze_all(spark, folder).__getitem__, STAMP, {"products": {"categories": PART_TYPES}}
    )
    return reduce(DataFrame.unionByName, [_content("silver", n, df) for n, df in cleaned.items()])


QUERIES |= {
    "sample_rows": lambda spark, folder: present(
        reports.sample_rows(run_named("rfm_analysis", _gold(spark, folder)), "customer_id")
    ),
    "customer_features": lambda spark, folder: present(
        features.customer_features(from_star_schema(spark, folder), AS_OF, CATEGORIES)
    ),
    "product_features": lambda spark, folder: present(
        features.product_features(from_star_schema(spark, folder), CATEGORIES)
    ),
    "store_features": lambda spark, folder: present(features.store_features(_gold(spark, folder))),
    **{
        name: storage_queries.on_folder(build)
        for name, build in ModelQueries(AS_OF, CATEGORIES).named().items()
    },
    "run_named": _analysis("top_customers"),
    "run_all": _run_all,
    "run_layers": _run_layers,
    "bronze_ingest_all": _ingest_all,
    "silver_process_all": _process_all,
}
