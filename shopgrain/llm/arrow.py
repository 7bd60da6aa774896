"""Small steps between Arrow batches and numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

ROWS = 512
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: int = 8 << 20) -> Iterator[None]:
    """Jobs started inside send texts to Python in batches of ``size`` bytes: several are held at a time, on both sides."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, size)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None


def give_back() -> None:
    """Memory that is free but held goes back to the system: workers live on between stages."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, which bounds what a task unpacks at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        batch = None
        give_back()


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of a text column; a longer text is alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(lengths.astype(np.int64)), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(at, to - at)
            at = to
        batch = lengths = None
        give_back()


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """Every text; null is empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from the values of all rows, one after another, and each row's number of them."""
    ends = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type=kind))
