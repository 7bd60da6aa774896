"""Column helpers shared by the analyses. All are built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"
WIDE_MONEY = "decimal(22,2)"
FINE = "decimal(24,6)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quotient(
    num: str | Column, den: str | Column, digits: int, times: int = 1, unit: str = WIDE_MONEY
) -> Column:
    """``num * times / den`` rounded half up to ``digits``; NULL when ``den`` is 0.

    Both sides are narrowed first, so that Spark keeps at least 12 decimals of the
    quotient before the rounding. ``unit`` is the type ``num`` fits in exactly.
    """
    top = col(num).cast(unit) * F.lit(times)
    bottom = col(den).cast(WIDE_MONEY)
    return F.round(top / F.nullif(bottom, F.lit(0).cast(WIDE_MONEY)), digits)


def mean(
    value: str | Column, digits: int, count: str | Column | None = None, unit: str = WIDE_MONEY
) -> Column:
    """Average of a money or integer column, rounded once.

    With ``count`` the column already holds partial sums of ``count`` rows each.
    """
    n = F.count(col(value)) if count is None else F.sum(col(count))
    return quotient(F.sum(col(value)), n, digits, unit=unit)


def percent(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    return quotient(num, den, digits, times=100)


def month_start(date: str | Column) -> Column:
    return F.trunc(col(date), "month")


def label(cases: list[tuple[Column, str]], otherwise: str) -> Column:
    """First matching label of ``cases``."""
    head, *rest = cases
    chain = reduce(lambda acc, c: acc.when(c[0], F.lit(c[1])), rest, F.when(head[0], F.lit(head[1])))
    return chain.otherwise(F.lit(otherwise))


def season(month: str | Column) -> Column:
    m = col(month)
    return label(
        [(m.isin(3, 4, 5), "Spring"), (m.isin(6, 7, 8), "Summer"), (m.isin(9, 10, 11), "Fall")],
        "Winter",
    )


def parse_money(text: str | Column) -> Column:
    """``£1,234.50`` to a number; what is not a number gives NULL."""
    return F.regexp_replace(col(text), "[£,]", "").try_cast("decimal(18,2)")


def as_of_date(as_of: str) -> Column:
    return F.lit(as_of).cast("date")


def present(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, the form results are exchanged in."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
