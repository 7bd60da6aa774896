"""Row numbers over a whole table, without a window that holds it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopgrain.sources.scratch import settle


def numbered(df: DataFrame, order: Sequence[Column], name: str, total: str | None = None) -> DataFrame:
    """``df`` sorted by ``order``, with ``name``: 0, 1, ... in that order.

    With ``total`` (a column) also ``<total>_before``: its sum over all earlier
    rows. Rows are range-sorted and settled; the one small side is a row for each
    sort partition. For numbers that do not depend on how partitions fall,
    ``order`` has to tell rows apart that differ.
    """
    place = F.monotonically_increasing_id()
    sorted_rows = settle(
        df.orderBy(*order)
        .withColumn("__id", place)
        .withColumn("__part", F.shiftright("__id", 33).cast("int"))
        .withColumn("__pos", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__id"),
        "sorted",
    )
    sums = [F.count(F.lit(1)).alias("__rows")] + ([F.sum(total).alias("__total")] if total else [])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        sorted_rows.groupBy("__part")
        .agg(*sums)
        .select(
            "__part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("__rows", "__total")[: len(sums)]]
        )
    )
    out = sorted_rows.join(F.broadcast(shifts), "__part").withColumn(name, F.col("__rows_before") + F.col("__pos"))
    if total:
        inside = Window.partitionBy("__part").orderBy("__pos").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn(f"{total}_before", F.col("__total_before") + F.coalesce(F.sum(total).over(inside), F.lit(0)))
    return out.drop("__part", "__pos", "__rows_before", "__total_before")
