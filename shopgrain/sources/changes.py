"""Files of change events, in the two forms sources deliver them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OP, STAMP = "Op", "__dms_timestamp"
OPS = ("c", "r", "u", "d")  # insert, snapshot, update, delete
_CORRUPT = "__corrupt"


def envelope(row: T.StructType) -> T.StructType:
    """``payload.{op, before, after, ts_ms}`` around a table's row."""
    return T.StructType().add(
        "payload",
        T.StructType()
        .add("op", "string")
        .add("before", row)
        .add("after", row)
        .add("ts_ms", "long"),
    )


def read_cdc_json(spark: SparkSession, path: str, row: T.StructType) -> DataFrame:
    """JSON Lines envelopes. The schema is given, so nothing is read to infer it."""
    return spark.read.schema(envelope(row)).json(path)


def judged_events(lines: DataFrame, row: T.StructType, key: str) -> DataFrame:
    """``payload, line, reason`` of text lines (``value``): why a line is no event of the table, null if it is one.

    ``malformed``: no JSON, or a value of another type; ``no envelope``; ``unknown op``;
    ``no row``: without the image that its op needs; ``no key``; ``no time``. Empty
    lines are none.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = lines.where(F.trim("value") != "").select(
        F.col("value").alias("line"), F.from_json("value", envelope(row).add(_CORRUPT, "string"), options).alias("e")
    )
    op = F.col("payload.op")
    image = F.when(op == "d", F.col("payload.before")).otherwise(F.col("payload.after"))
    reasons = (
        (F.col(_CORRUPT).isNotNull(), "malformed"),
        (op.isNull(), "no envelope"),
        (~op.isin(*OPS), "unknown op"),
        (image.isNull(), "no row"),
        (image[key].isNull(), "no key"),
        (F.col("payload.ts_ms").isNull(), "no time"),
    )
    reason = F.coalesce(*[F.when(wrong, name) for wrong, name in reasons])
    return parsed.select("line", F.col("e.payload").alias("payload"), F.col(f"e.{_CORRUPT}").alias(_CORRUPT)).select(
        "payload", "line", reason.alias("reason")
    )


def read_judged(spark: SparkSession, path: str, row: T.StructType, key: str) -> DataFrame:
    return judged_events(spark.read.text(path), row, key)


def accepted(judged: DataFrame) -> DataFrame:
    """The events, as ``cdc_split`` takes them."""
    return judged.where("reason IS NULL").select("payload")


def quarantined(judged: DataFrame) -> DataFrame:
    """The lines that are no events, as they came, with the reason."""
    return judged.where("reason IS NOT NULL").select("line", "reason")


def write_cdc_json(events: DataFrame, path: str) -> None:
    events.write.mode("overwrite").json(path)


def read_cdc_op(spark: SparkSession, path: str, row: T.StructType, since: str | None = None) -> DataFrame:
    """Parquet replication records under one folder per day, with the day (YYYYMMDD) as ``day``.

    Folders are named ``day=YYYYMMDD`` or ``YYYYMMDD``. Only those from ``since`` on
    are listed and read.
    """
    schema = T.StructType(list(row.fields)).add(OP, "string").add(STAMP, "timestamp")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in folder.getFileSystem(conf).listStatus(folder) if s.isDirectory()]
    days = {n.removeprefix("day="): n for n in names if n.removeprefix("day=").isdigit()}
    wanted = [f"{path}/{n}" for d, n in sorted(days.items()) if since is None or d >= since]
    if not wanted:
        return spark.createDataFrame([], schema.add("day", "string"))
    day = F.regexp_extract("_metadata.file_path", r"/(?:day=)?([0-9]+)/[^/]*$", 1)
    return spark.read.schema(schema).parquet(*wanted).withColumn("day", day)
