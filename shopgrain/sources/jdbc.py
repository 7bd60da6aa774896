"""Tables of a relational database, read and written in parallel."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shopgrain.sources.retail import KEYS, TABLES

log = logging.getLogger(__name__)

# Parents before children, so that foreign keys hold while tables are filled.
COPY_ORDER = ("stores", "customers", "products", "employees", "orders", "sales")


@dataclass(frozen=True)
class Slices:
    """How a table is cut into parallel range reads of one numeric or date column."""

    column: str
    lower: str | int
    upper: str | int
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.count),
        }


@dataclass(frozen=True)
class Database:
    """Where the database is. ``properties`` holds user, password and driver."""

    url: str
    properties: Mapping[str, str]
    fetch_size: int = 10_000
    batch_size: int = 10_000

    def read_options(self, table: str, slices: Slices | None = None) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": table,
            "fetchsize": str(self.fetch_size),
            **self.properties,
            **(slices.options() if slices else {}),
        }

    def write_options(self, table: str, keep_table: bool = False) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": table,
            "batchsize": str(self.batch_size),
            **self.properties,
            **({"truncate": "true"} if keep_table else {}),
        }


def read_jdbc(
    spark: SparkSession, db: Database, table: str, slices: Slices | None = None
) -> DataFrame:
    """A table as a lazy DataFrame; filters and columns are pushed into the database.

    Without ``slices`` the table comes over one connection into one task, so large
    tables need them.
    """
    return spark.read.format("jdbc").options(**db.read_options(table, slices)).load()


def key_slices(spark: SparkSession, db: Database, table: str, count: int) -> Slices | None:
    """Slices over the table's key, between its bounds in the database."""
    key = KEYS[table]
    bounds = read_jdbc(spark, db, f"(SELECT min({key}) AS lo, max({key}) AS hi FROM {table}) b").first()
    return None if bounds["lo"] is None else Slices(key, bounds["lo"], bounds["hi"] + 1, count)


def read_all_jdbc(
    read: Callable[[str], DataFrame], tables: Iterable[str] = TABLES
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Every table that can be opened, and the message of each that cannot."""
    opened, failed = {}, {}
    for table in tables:
        try:
            opened[table] = read(table)
        except Exception as error:
            failed[table] = str(error)
            log.warning("could not open %s: %s", table, error)
    return opened, failed


def write_jdbc(
    df: DataFrame, db: Database, table: str, mode: str = "overwrite", keep_table: bool = False
) -> None:
    """Write over parallel connections. ``keep_table`` empties the table instead of remaking it."""
    df.write.format("jdbc").options(**db.write_options(table, keep_table)).mode(mode).save()


def copy_tables(
    read: Callable[[str], DataFrame],
    write: Callable[[DataFrame, str], None],
    empty: Callable[[str], None] | None = None,
    tables: Iterable[str] = COPY_ORDER,
) -> list[str]:
    """Copy tables, emptied children first, then filled parents first."""
    names = list(tables)
    if empty:
        for table in reversed(names):
            empty(table)
    for table in names:
        write(read(table), table)
    return names
