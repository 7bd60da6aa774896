"""Change events applied as they arrive."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shopgrain.operators.cdc import cdc_merge, cdc_split, with_marks
from shopgrain.sources.changes import accepted, judged_events, quarantined
from shopgrain.sources.layers import (
    bucket,
    bucketed_state,
    finish_replacing,
    read_bucketed,
    replace_buckets,
    write_bucketed,
)
from shopgrain.sources.scratch import passing, settle


QUARANTINE = "line string, reason string, batch string"


def quarantine_path(table_path: str) -> str:
    """Where a table's stream keeps the lines that are no events."""
    return f"{table_path}/_quarantine"


def read_quarantine(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.schema(QUARANTINE).parquet(quarantine_path(table_path))


def cdc_stream_merge(
    spark: SparkSession,
    events_path: str,
    table_path: str,
    row: T.StructType,
    key: str,
    checkpoint: str,
    trigger: dict | None = None,
    files_per_batch: int | None = None,
    buckets: int = 64,
) -> StreamingQuery:
    """Merge JSON envelopes into a bucketed table, batch by batch.

    A batch reads and rewrites the buckets that its keys fall into, and leaves the
    others' files alone; what a batch settles goes with it. Lines that are no events of
    the table are kept with the reason in a folder for each batch, which a repeated batch
    replaces. ``buckets`` counts only for a table that is not
    there yet. A batch that is repeated after a failure first ends what the failed one had begun to
    replace and merges to the same rows. The default
    trigger works off what has arrived and stops; give
    ``{"processingTime": "1 minute"}`` to keep running.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def apply(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        if bucketed_state(session, table_path) is None:
            write_bucketed(with_marks(session.createDataFrame([], row)), table_path, key, buckets)
        finish_replacing(session, table_path)
        parts = bucketed_state(session, table_path)["buckets"]
        with passing(session):
            judged = judged_events(batch, row, key)
            kept = f"{quarantine_path(table_path)}/batch={run}-{epoch}"
            quarantined(judged).write.mode("overwrite").parquet(kept)
            changes = settle(cdc_split(accepted(judged)), "batch")
            # At most one number per bucket.
            touched = [r[0] for r in changes.select(bucket(key, parts)).distinct().collect()]
            if touched:
                table = read_bucketed(session, table_path, touched)
                replace_buckets(cdc_merge(table, changes, key), table_path)

    return (
        reader.text(events_path)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
