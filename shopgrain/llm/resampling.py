"""Resampling of documents by importance: those most like a target set, drawn with Gumbel noise.

Hashed n-gram features are counted over all documents and over the target; a
feature's gain is the log ratio of its smoothed shares. Newlines separate words, so
a text falls into lines whose features do not depend on their neighbours. Each
distinct line is looked at once: its features count as often as the line occurs, and
its weight goes to every document that holds it. Only n-grams that reach across a
line break belong to a document alone; they are counted and weighed apart.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.arrow import by_bytes, small_batches
from shopgrain.llm.order import numbered
from shopgrain.sources.scratch import settle

BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20

#: A-Z become a-z, other characters below 0x80 but digits and a-z become blanks. Lengths do not change.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def _split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Of all words, in order: the row each is from, its number in the list of distinct words, and that list."""
    texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])  # own buffers, from offset 0
    _, offsets, data = texts.buffers()
    plain = data.to_pybytes().translate(_PLAIN) if data else b""
    lowered = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, offsets, pa.py_buffer(plain)])
    split = pc.ascii_split_whitespace(lowered.cast(pa.large_string()))
    coded = split.flatten().cast(pa.large_binary()).dictionary_encode()
    distinct, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    rows = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    if b"" in distinct:
        full = index != distinct.index(b"")
        rows, index = rows[full], index[full]
    return rows, index, distinct


def features(
    rows: np.ndarray, index: np.ndarray, distinct: list[bytes], longest: int, lines: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, checksums) of the runs of 1, 2, .. ``longest`` words inside a row.

    With ``lines`` (of each word), only of the runs that begin and end on different lines.
    """
    checksums = np.fromiter(map(zlib.crc32, distinct), np.uint32, len(distinct))[index]
    if lines is None:
        yield rows, checksums
    spaced = [b" " + w for w in distinct]
    for n in range(2, longest + 1):
        ends = index[n - 1 :].tolist()
        checksums = np.fromiter(
            (zlib.crc32(spaced[i], c) for i, c in zip(ends, checksums.tolist())), np.uint32, len(ends)
        )
        inside = rows[: len(ends)] == rows[n - 1 :]
        if lines is not None:
            inside &= lines[: len(ends)] != lines[n - 1 :]
        yield rows[: len(ends)][inside], checksums[inside]


def _words_on_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    split = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    owner = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    lines, index, distinct = _split(split.flatten())
    return owner[lines], index, distinct, lines


def _found(batch: pa.RecordBatch, longest: int, across: bool):
    """Features of a batch of lines, or those across the lines of a batch of texts."""
    if across:
        rows, index, distinct, lines = _words_on_lines(batch.column("text"))
        return features(rows, index, distinct, longest, lines)
    return features(*_split(batch.column("text")), longest)


def _counting(longest: int, buckets: int, across: bool):
    """text, times -> bucket, count: one row for each bucket that a task has met."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in by_bytes(batches, "text"):
            times = batch.column("times").to_numpy()
            for rows, checksums in _found(batch, longest, across):
                np.add.at(total, checksums % np.uint32(buckets), times[rows])
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "count"])

    return task


def _weighing(keys: list[str], gains: np.ndarray, longest: int, across: bool):
    """keys, text -> keys, n_words, n_features, weight."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            n = batch.num_rows
            words, count, weight = (np.zeros(n, np.int64) for _ in range(3))
            for step, (rows, checksums) in enumerate(_found(batch, longest, across)):
                held = np.bincount(rows, minlength=n)
                count += held
                if step == 0 and not across:
                    words += held
                np.add.at(weight, rows, gains[checksums % np.uint32(len(gains))])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), *map(pa.array, (words, count, weight))],
                [*keys, "n_words", "n_features", "weight"],
            )

    return task


def _lines(texts: DataFrame) -> DataFrame:
    return texts.select("*", F.explode(F.split("text", "\n", -1)).alias("line")).where("line <> ''")


def _name(line: str) -> list[Column]:
    """Two 64-bit hashes under which a line's weight is looked up."""
    return [F.xxhash64(line).alias("line_a"), F.xxhash64(F.lit("line"), line).alias("line_b")]


def bucket_counts(texts: DataFrame, lines: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How many features of ``texts`` (text) fall into each bucket; ``lines`` are its distinct lines."""
    schema = "bucket long, count long"
    found = lines.select("text", "times").mapInArrow(_counting(longest, buckets, False), schema)
    if longest > 1:
        once = texts.select("text", F.lit(1).cast("long").alias("times"))
        found = found.unionByName(once.mapInArrow(_counting(longest, buckets, True), schema))
    counts = np.zeros(buckets, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("count").alias("count")).collect():  # a row a bucket
        counts[row["bucket"]] = row["count"]
    return counts


def _distinct_lines(texts: DataFrame) -> DataFrame:
    counted = _lines(texts.select("text")).groupBy("line").agg(F.count(F.lit(1)).alias("times"))
    return settle(counted.select(F.col("line").alias("text"), "times"), "lines")


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed target share by the smoothed source share) of each bucket."""
    n, more, less = len(source), float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * more / ((s + 1.0) * less))) for s, t in zip(source.tolist(), target.tolist())],
        np.int64,
    ).reshape(n)


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    longest: int = 1,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: str = "2024",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_features, weight, score, rank.

    Words are runs of characters from 0x80 on, digits and letters, A-Z as a-z;
    features are all runs of 1 to ``longest`` words, joined by a blank, in buckets
    by CRC-32 of their UTF-8. ``weight`` is the sum of the gains of a document's
    features, ``score`` adds Gumbel noise that depends on ``seed`` and doc_id.
    Of the documents with at least ``least_words`` words the ``percent`` % (rounded
    down) of highest scores are drawn and get their rank, from 1; ties go to the
    smaller doc_id, then to a hash of the text. The others have the rank null.

    Null and empty texts have no features and the weight 0. A null doc_id has the
    noise of an empty one and comes last among ties. Rows that repeat are
    documents of their own with the same score. Without target texts all buckets
    of the target count 0. An empty table gives no rows. Other columns of ``docs``
    are not read.
    """
    wanted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn(
        "text_hash", F.xxhash64("text")
    )
    aim = target.select(F.col(target_text).alias("text"))
    lines = _distinct_lines(wanted)
    with small_batches(docs.sparkSession):
        gains = bucket_gains(
            bucket_counts(wanted, lines, longest, buckets),
            bucket_counts(aim, _distinct_lines(aim), longest, buckets),
        )
        weights = settle(_weights(wanted, lines, gains, longest), "weights")
    rows = wanted.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    key = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text"))
    sums = ("n_words", "n_features", "weight")
    # Rows that repeat have added up; each gets its share, which is a whole number.
    each = rows.join(weights.toDF("of_doc", "of_text", *(f"all_{c}" for c in sums)), key, "left").select(
        "doc_id",
        "text_hash",
        *[F.coalesce(F.expr(f"all_{c} div rows"), F.lit(0).cast("long")).alias(c) for c in sums],
        F.explode(F.expr("array_repeat(0, cast(rows as int))")).alias("again"),
    )
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    uniform = (noise.cast("double") + 0.5) / 4294967296.0
    scored = settle(
        each.drop("again").withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform)))), "scored"
    )
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    placed = numbered(able, [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("text_hash")], "place")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    rest = scored.where(F.col("n_words") < least_words)
    return placed.select(*columns, rank.alias("rank")).unionByName(
        rest.select(*columns, F.lit(None).cast("long").alias("rank"))
    )


def _weights(wanted: DataFrame, lines: DataFrame, gains: np.ndarray, longest: int) -> DataFrame:
    """doc_id, text_hash, n_words, n_features, weight; rows that repeat add up."""
    doc = wanted.schema["doc_id"].dataType.simpleString()
    sums = "n_words long, n_features long, weight long"
    weighed = settle(
        lines.select(*_name("text"), "text").mapInArrow(
            _weighing(["line_a", "line_b"], gains, longest, False), f"line_a long, line_b long, {sums}"
        ),
        "line_weights",
    )
    places = (
        _lines(wanted)
        .select("doc_id", "text_hash", *_name("line"))
        .groupBy("doc_id", "text_hash", "line_a", "line_b")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    parts = places.join(weighed, ["line_a", "line_b"]).select(
        "doc_id",
        "text_hash",
        *[(F.col(c) * F.col("times")).alias(c) for c in ("n_words", "n_features", "weight")],
    )
    if longest > 1:
        parts = parts.unionByName(
            wanted.select("doc_id", "text_hash", "text").mapInArrow(
                _weighing(["doc_id", "text_hash"], gains, longest, True), f"doc_id {doc}, text_hash long, {sums}"
            )
        )
    return parts.groupBy("doc_id", "text_hash").agg(
        *[F.sum(c).alias(c) for c in ("n_words", "n_features", "weight")]
    )
