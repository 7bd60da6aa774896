"""Intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    A folder of its own is made only when none is named and Spark runs inside
    this one process; a cluster has to name one that every executor reaches.
    """
    named = spark.conf.get(_CONF, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CONF} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="shopgrain-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` once and read it back.

    The result survives the loss of executors, has exact size statistics, and
    is the same however often it is read.
    """
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/settled/{spark.sparkContext.applicationId}"


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is settled inside is deleted at the end, for work whose results are written elsewhere."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete(spark, path)


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs inside are deleted when it ends, not when the driver collects its garbage."""
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE)
        else:
            spark.conf.set(_FREE, before)


def delete(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(conf).delete(folder, True)


def discard_settled(spark: SparkSession) -> None:
    """Delete what this application settled. Results built on it can no longer be read."""
    delete(spark, _own_folder(spark))
