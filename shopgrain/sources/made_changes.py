"""Change events made by rule from orders, for every order.

Each order has a stale and a valid update. Completed ones are also snapshot, pending
ones deleted, and shipped ones followed by a new order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.sources.changes import OP, STAMP
from shopgrain.sources.retail import Retail

NEW_ORDERS = 1_000_000_000_000
START_MS = 996_624_000_000  # 2001-08-01
DAY_MS = 86_400_000

ROW = (
    T.StructType()
    .add("order_id", "long")
    .add("customer_id", "long")
    .add("order_date", "date")
    .add("status", "string")
)


def target(t: Retail) -> DataFrame:
    return t.order_heads.select(*ROW.fieldNames())


def _row(status: Column, shift: int = 0) -> Column:
    return F.struct(
        (F.col("order_id") + shift).alias("order_id"),
        F.col("customer_id"),
        F.col("order_date"),
        status.alias("status"),
    )


def change_events(t: Retail) -> DataFrame:
    """Envelopes: ``payload.{op, before, after, ts_ms}``."""
    status, nothing = F.col("status"), F.lit(None).cast(ROW)
    base = F.lit(START_MS) + (F.col("order_id") % 3) * DAY_MS

    def event(op: str, offset: int, before: Column, after: Column) -> Column:
        return F.struct(
            F.lit(op).alias("op"), before.alias("before"), after.alias("after"), (base + offset).alias("ts_ms")
        )

    events = F.array(
        event("u", 1000, _row(status), _row(F.lit("stale"))),
        event("u", 2000, _row(F.lit("stale")), _row(F.upper(status))),
        F.when(status == "Completed", event("r", 500, nothing, _row(status))),
        F.when(status == "Pending", event("d", 3000, _row(F.upper(status)), nothing)),
        F.when(status == "Shipped", event("c", 4000, nothing, _row(status, NEW_ORDERS))),
    )
    return target(t).select(F.explode(F.array_compact(events)).alias("payload"))


def op_records(t: Retail) -> DataFrame:
    """The same changes as replication records."""
    op = F.col("payload.op")
    names = F.create_map(*[F.lit(x) for x in ("c", "I", "r", "I", "u", "U", "d", "D")])
    row = F.when(op == "d", F.col("payload.before")).otherwise(F.col("payload.after"))
    return change_events(t).select(
        row.alias("row"), names[op].alias(OP), F.timestamp_millis("payload.ts_ms").alias(STAMP)
    ).select("row.*", OP, STAMP)
