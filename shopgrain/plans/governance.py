"""What analysts and auditors see."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from shopgrain.operators.gold import GOLD_TABLES

# Columns that identify persons, which analysts are not shown.
PII = ("email", "phone", "salary")


def analyst_view(read: Callable[[str], DataFrame], table: str, prefix: str = "analyst_") -> DataFrame:
    """A gold table without personal columns, registered as a view; other tables are refused.

    Dropped columns are not even read.
    """
    if table not in GOLD_TABLES:
        raise PermissionError(f"{table!r} is not a gold table; analysts see {', '.join(GOLD_TABLES)}")
    view = read(table).drop(*PII)
    view.createOrReplaceTempView(f"{prefix}{table}")
    return view


def auditor_view(bronze: DataFrame) -> DataFrame:
    """A raw table as it is, its change columns included."""
    return bronze
