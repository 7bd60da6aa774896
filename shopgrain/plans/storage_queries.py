"""Sources, sinks and the catalog as queries: whole tables written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopgrain.functions.columns import present
from shopgrain.operators import cdc, history
from shopgrain.operators.gold import CustomerRules, Gold
from shopgrain.plans.governance import analyst_view, auditor_view
from shopgrain.sources import catalog, changes, layers, made_changes
from shopgrain.sources.retail import TABLES, Retail
from shopgrain.sources.scratch import shared_folder
from shopgrain.streaming.cdc_stream import cdc_stream_merge as _stream_merge

AS_OF = "2001-08-02"
# Customer borders that split the test tables' far larger amounts.
RULES = CustomerRules(vip=2_800_000, high=2_100_000, medium=1_400_000)


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/queries/{name}-{uuid.uuid4().hex}"


def read_layer(spark: SparkSession, t: Retail) -> DataFrame:
    root = _place(spark, "layer")
    layers.write_layer(t.orders, root, "silver", "orders")
    return layers.read_layer(spark, root, "silver", "orders")


def write_layer(spark: SparkSession, t: Retail) -> DataFrame:
    """A table replaced by what is computed from itself, with other columns."""
    root = _place(spark, "layer")
    layers.write_layer(t.order_heads.select("order_id", "customer_id", "order_date"), root, "gold", "orders")
    old = layers.read_layer(spark, root, "gold", "orders")
    renewed = old.join(t.order_heads.select("order_id", F.upper("status").alias("status")), "order_id")
    layers.write_layer(renewed.drop("order_date"), root, "gold", "orders")
    return layers.read_layer(spark, root, "gold", "orders")


def write_parquet_table(spark: SparkSession, t: Retail) -> DataFrame:
    path = _place(spark, "products")
    layers.write_parquet_table(t.products, path)
    return layers.read_parquet_table(spark, path)


def write_partitioned(spark: SparkSession, t: Retail) -> DataFrame:
    path = _place(spark, "orders")
    layers.write_partitioned(t.orders, path, "order_date", ("year", "month"))
    return spark.read.parquet(path)


def recover_partitions(spark: SparkSession, t: Retail) -> DataFrame:
    """Folders appear after the table was declared."""
    path, table = _place(spark, "orders"), f"orders_{uuid.uuid4().hex}"
    columns = "order_id bigint, customer_id bigint, employee_id bigint, order_date date, status string, year int"
    catalog.register_tables(spark, "default", lambda _: path, {table: columns}, ("year",))
    layers.write_partitioned(t.order_heads, path, "order_date", ("year",))
    catalog.recover_partitions(spark, f"default.{table}")
    return spark.table(f"default.{table}").groupBy("year").agg(F.count(F.lit(1)).alias("n"))


def union_evolving(spark: SparkSession, t: Retail) -> DataFrame:
    old = t.customers.select("customer_id", "first_name")
    new = t.customers.select(
        (F.col("customer_id") + 1_000_000_000).alias("customer_id"),
        F.concat(F.lit("p"), "customer_id").alias("phone"),
    )
    return layers.union_evolving(old, new)


def export_csv(spark: SparkSession, t: Retail) -> DataFrame:
    path = _place(spark, "csv")
    out = t.order_heads.select("order_id", "order_date", "status")
    layers.export_csv(out, path)
    return spark.read.schema(out.schema).option("header", "true").csv(path)


def _counts(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    union = None
    for table, name in names.items():
        one = spark.table(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(table).alias("table_name"), "n")
        union = one if union is None else union.unionByName(one)
    return union


def register_views(spark: SparkSession, t: Retail) -> DataFrame:
    prefix = f"silver_{uuid.uuid4().hex}_"
    catalog.register_views(t.table, [*TABLES, "returns"], prefix)
    return _counts(spark, {n: f"{prefix}{n}" for n in TABLES})


def register_tables(spark: SparkSession, t: Retail) -> DataFrame:
    """The six tables under declared columns, in a database of their own."""
    root, prefix = _place(spark, "lake"), f"lake_{uuid.uuid4().hex}"
    catalog.create_databases(spark, prefix, ("clean",))
    schemas = {n: _columns(t.table(n).schema) for n in TABLES}
    for name in TABLES:
        layers.write_parquet_table(t.table(name), f"{root}/{name}")
    catalog.register_tables(spark, f"{prefix}_clean", lambda n: f"{root}/{n}", schemas)
    return _counts(spark, {n: f"{prefix}_clean.{n}" for n in TABLES})


def _columns(schema: StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


# -- change events -----------------------------------------------------------


def read_cdc_json(spark: SparkSession, t: Retail) -> DataFrame:
    path = _place(spark, "events")
    changes.write_cdc_json(made_changes.change_events(t), path)
    return cdc.cdc_split(changes.read_cdc_json(spark, path, made_changes.ROW))


def read_cdc_op(spark: SparkSession, t: Retail) -> DataFrame:
    path = _place(spark, "records")
    day = F.date_format(changes.STAMP, "yyyyMMdd")
    made_changes.op_records(t).withColumn("day", day).write.partitionBy("day").parquet(path)
    return changes.read_cdc_op(spark, path, made_changes.ROW)


def quarantine_events(spark: SparkSession, t: Retail) -> DataFrame:
    """Lines of change events, some broken by rule, counted by what is wrong with them."""
    path = _place(spark, "lines")
    events = made_changes.change_events(t)
    number = F.coalesce("payload.after.order_id", "payload.before.order_id") % 7
    whole = F.to_json(F.struct("payload"))
    line = (
        F.when(number == 1, F.substring(whole, 1, 20))
        .when(number == 2, F.regexp_replace(whole, '"op":"', '"op":"x'))
        .when(number == 3, F.lit('{"other":1}'))
        .when(number == 4, F.to_json(F.struct(F.struct("payload.op", "payload.ts_ms").alias("payload"))))
        .otherwise(whole)
    )
    events.select(line.alias("value")).write.text(path)
    judged = changes.read_judged(spark, path, made_changes.ROW, "order_id")
    return judged.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count(F.lit(1)).alias("lines"))


def load_since_mark(spark: SparkSession, t: Retail) -> DataFrame:
    """Orders in two loads; the second one finds the day of the first one's mark again, with later rows."""
    path = _place(spark, "orders")
    dated = t.order_heads.select("order_id", "status", F.col("order_date").cast("timestamp").alias("updated_at"))
    early = F.col("updated_at") <= F.lit("1998-06-30").cast("timestamp")
    cdc.load_since_mark(dated.where(early & (F.col("order_id") % 3 > 0)), path, "order_id")
    changed = F.when(F.col("order_id") % 5 == 0, F.upper("status")).otherwise(F.col("status"))
    on_mark = F.col("updated_at") >= F.lit("1998-06-30").cast("timestamp")
    return cdc.load_since_mark(dated.where(on_mark).withColumn("status", changed), path, "order_id")


def cdc_split(spark: SparkSession, t: Retail) -> DataFrame:
    return cdc.cdc_split(made_changes.change_events(t))


def cdc_upsert(spark: SparkSession, t: Retail) -> DataFrame:
    return cdc.cdc_upsert(made_changes.target(t), cdc_split(spark, t), "order_id").drop(cdc.VALUE_TS)


def cdc_soft_delete(spark: SparkSession, t: Retail) -> DataFrame:
    return cdc.cdc_soft_delete(made_changes.target(t), cdc_split(spark, t), "order_id").drop(cdc.VALUE_TS)


def cdc_counts(spark: SparkSession, t: Retail) -> DataFrame:
    return cdc.cdc_counts(cdc_split(spark, t))


def cdc_apply_op(spark: SparkSession, t: Retail) -> DataFrame:
    return cdc.cdc_apply_op(made_changes.target(t), made_changes.op_records(t), "order_id").drop(cdc.VALUE_TS)


def cdc_stream_merge(spark: SparkSession, t: Retail) -> DataFrame:
    """The events as a file stream into a bucketed table."""
    root = _place(spark, "stream")
    changes.write_cdc_json(made_changes.change_events(t), f"{root}/events")
    layers.write_bucketed(cdc.with_marks(made_changes.target(t)), f"{root}/orders", "order_id", 8)
    stream = _stream_merge(
        spark, f"{root}/events", f"{root}/orders", made_changes.ROW, "order_id", f"{root}/checkpoint"
    )
    stream.awaitTermination()
    return layers.read_bucketed(spark, f"{root}/orders").drop(cdc.VALUE_TS)


def incremental_by_updated_at(spark: SparkSession, t: Retail) -> DataFrame:
    dated = t.order_heads.select(
        "order_id", "status", F.col("order_date").cast("timestamp").alias("updated_at")
    )
    return cdc.incremental_by_updated_at(dated, "2000-06-30")


def scd2(spark: SparkSession, t: Retail) -> DataFrame:
    """A customer's order status as it changed, by the last order of each day."""
    history = t.order_heads.groupBy("customer_id", "order_date").agg(
        F.max_by("status", "order_id").alias("status")
    )
    return cdc.scd2(history, "customer_id", "order_date", ["status"])


def scd2_merge(spark: SparkSession, t: Retail) -> DataFrame:
    """Customers, a third of whom moved."""
    dimension = t.customers.select(
        "customer_id",
        F.lit("1995-01-01").cast("date").alias("effective_from"),
        "city",
        "country",
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    moved = F.when(F.col("customer_id") % 3 == 0, "*").otherwise("")
    snapshot = t.customers.select("customer_id", "city", F.concat(F.upper("country"), moved).alias("country"))
    return cdc.scd2_merge(dimension, snapshot, "customer_id", ["city", "country"], "2001-08-02")


def scd2_snapshots(spark: SparkSession, t: Retail) -> DataFrame:
    """Customers by the status of their last order, seen on three days and loaded out of order.

    The second snapshot, which comes last, lacks every fifth customer.
    """
    path = _place(spark, "history")
    for day in ("2000-12-31", "1996-12-31", "1998-12-31"):
        seen = t.order_heads.where(F.col("order_date") <= F.lit(day).cast("date"))
        if day == "1998-12-31":
            seen = seen.where(F.col("customer_id") % 5 > 0)
        last = seen.groupBy("customer_id").agg(
            F.max_by("status", F.struct("order_date", "order_id")).alias("status")
        )
        result = history.load_snapshot(last, path, "customer_id", ["status"], day)
    return result


def union_evolving_types(spark: SparkSession, t: Retail) -> DataFrame:
    """Three generations of orders: a number became a text, a day a time, and a nested row gained a field."""
    first = t.order_heads.where("order_id % 3 = 0").select(
        F.col("order_id").cast("int").alias("order_id"),
        F.col("order_date").alias("at"),
        F.col("customer_id").alias("buyer"),
        F.struct("status").alias("detail"),
    )
    second = t.order_heads.where("order_id % 3 = 1").select(
        "order_id",
        F.col("order_date").cast("timestamp").alias("at"),
        F.concat(F.lit("C"), "customer_id").alias("buyer"),
        F.struct("status", F.month("order_date").alias("month")).alias("detail"),
    )
    third = t.order_heads.where("order_id % 3 = 2").select(
        F.struct(F.dayofmonth("order_date").alias("month"), F.upper("status").alias("status")).alias("detail"),
        "order_id",
    )
    return layers.union_evolving(first, second, third).select(
        "order_id", "at", "buyer", F.col("detail.status").alias("status"), F.col("detail.month").alias("month")
    )


def analyst(spark: SparkSession, t: Retail) -> DataFrame:
    """The customers' gold table, read through the view."""
    gold, prefix = Gold(t, AS_OF, RULES), f"analyst_{uuid.uuid4().hex}_"
    analyst_view(lambda name: getattr(gold, name), "customer_analytics", prefix)
    return spark.table(f"{prefix}customer_analytics")


def auditor(spark: SparkSession, t: Retail) -> DataFrame:
    return auditor_view(cdc_soft_delete(spark, t))


QUERIES = {
    "read_layer": read_layer,
    "write_layer": write_layer,
    "write_parquet_table": write_parquet_table,
    "write_partitioned": write_partitioned,
    "recover_partitions": recover_partitions,
    "union_evolving": union_evolving,
    "union_evolving_types": union_evolving_types,
    "export_csv": export_csv,
    "register_views": register_views,
    "register_tables": register_tables,
    "read_cdc_json": read_cdc_json,
    "read_cdc_op": read_cdc_op,
    "quarantine_events": quarantine_events,
    "load_since_mark": load_since_mark,
    "cdc_split": cdc_split,
    "cdc_upsert": cdc_upsert,
    "cdc_soft_delete": cdc_soft_delete,
    "cdc_counts": cdc_counts,
    "cdc_apply_op": cdc_apply_op,
    "cdc_stream_merge": cdc_stream_merge,
    "incremental_by_updated_at": incremental_by_updated_at,
    "scd2": scd2,
    "scd2_merge": scd2_merge,
    "scd2_snapshots": scd2_snapshots,
    "analyst_view": analyst,
    "auditor_view": auditor,
}


def on_folder(build):
    """A query over a star-schema folder, its timestamps without a zone."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        from shopgrain.sources.retail import from_star_schema

        df = present(build(spark, from_star_schema(spark, folder)))
        return df.select(
            *[
                F.col(n).cast("timestamp_ntz").alias(n) if kind == "timestamp" else F.col(n)
                for n, kind in df.dtypes
            ]
        )

    return run
