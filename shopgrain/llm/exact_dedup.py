"""Exact duplicates by deterministic block naming.

A text, A-Z as a-z, is cut into blocks of ``BLOCK`` bytes. All distinct blocks are
sorted, and a block's place becomes its name, an integer. Then two neighbouring
names are one pair, all distinct pairs are sorted and named, and so on until each
document has one name left; a name without a neighbour is paired with none. Two
documents are equal if and only if they have the same number of levels and the
same last name: names are given to the values themselves, no hash decides.

Occurrences look their block's name up by the block's 64-bit hash where only one
distinct block has that hash, and by the block itself where several have it, so
whole blocks are shuffled once, one row for each block and batch that holds it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.arrow import slices, small_batches, text_bytes
from shopgrain.sources.scratch import settle

BLOCK = 4096


def normalised(column: pa.Array) -> list[bytes]:
    """UTF-8 of the texts with A-Z lower-cased; null is empty."""
    return text_bytes(pc.ascii_lower(column))


def cut(text: bytes) -> list[bytes]:
    """The blocks of a text; the empty text is one empty block."""
    return [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)] or [b""]


def _hash(block: bytes, bits: int) -> int:
    return xxhash.xxh3_64_intdigest(block) >> (65 - bits)


def _distinct(bits: int):
    """text -> the distinct blocks of each batch, with their hashes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            blocks = list({b for text in normalised(batch.column("text")) for b in cut(text)})
            yield _table([(_hash(b, bits), b) for b in blocks], hash=pa.int64(), block=pa.binary())

    return task


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by hash and block -> one row per distinct block with its name.

    Names are the task's number and the place in it. ``several`` tells that
    another block has the same hash; only then the block itself goes on.
    """
    kinds = {"hash": pa.int64(), "name": pa.int64(), "several": pa.bool_(), "block": pa.binary()}
    place = TaskContext.get().partitionId() << 40
    of, group = None, []

    def rows() -> list[tuple]:
        several = len(group) > 1
        return [(of, place + i, several, b if several else None) for i, b in enumerate(group)]

    for batch in slices(batches, 4096):
        done = []
        for h, block in zip(batch.column("hash").to_pylist(), batch.column("block").to_pylist()):
            if h != of:
                done += rows()
                place += len(group)
                of, group = h, [block]
            elif block != group[-1]:
                group.append(block)
        yield _table(done, **kinds)
    yield _table(rows(), **kinds)


def _occurrences(bits: int):
    """doc_id, text -> row, doc_id, digest of the text, hashes of its blocks in order."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            texts = normalised(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + batch.num_rows)),
                    batch.column("doc_id"),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                    pa.array([[_hash(b, bits) for b in cut(t)] for t in texts], pa.list_(pa.int64())),
                ],
                ["row", "doc_id", "text_sha256", "hashes"],
            )
            row += batch.num_rows

    return task


def _blocks_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, text_sha256, spot, text -> row, spot, block, where the text is the row's."""
    for batch in slices(batches):
        rows = zip(*(batch.column(c).to_pylist() for c in ("row", "text_sha256", "spot")), normalised(batch.column("text")))
        yield _table(
            [(row, spot, cut(t)[spot]) for row, sha, spot, t in rows if hashlib.sha256(t).hexdigest() == sha],
            row=pa.int64(), spot=pa.int32(), block=pa.binary(),
        )


def _table(rows: list[tuple], **kinds: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], list(kinds))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hash_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: which row of its group of equal texts stays.

    Texts are equal when identical after lower-casing A-Z; a null text is an
    empty one. The row with the largest doc_id stays; of rows with that doc_id
    and an equal text exactly one does; null doc_ids are smaller than any other.

    Result: doc_id, keep_id (doc_id of the row that stays), group_size, kept,
    text_sha256 (lowercase hex of the normalised text in UTF-8). An empty table
    gives no rows. Other columns of ``docs`` are not read. ``hash_bits`` is there
    for tests: fewer bits make hashes collide, results stay the same.
    """
    wanted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = wanted.schema["doc_id"].dataType.simpleString()
    named = (
        wanted.select("text")
        .mapInArrow(_distinct(hash_bits), "hash long, block binary")
        .repartition("hash")
        .sortWithinPartitions("hash", "block")
        .mapInArrow(_named, "hash long, name long, several boolean, block binary")
    )
    occurring = wanted.mapInArrow(
        _occurrences(hash_bits), f"row long, doc_id {id_type}, text_sha256 string, hashes array<long>"
    )
    with small_batches(docs.sparkSession):
        names, rows = settle(named, "names"), settle(occurring, "rows")
    spots = rows.select("row", F.posexplode("hashes").alias("spot", "hash"))
    found = spots.join(names.where("not several").select("hash", "name"), "hash").select("row", "spot", "name")
    if not names.where("several").isEmpty():
        found = found.unionByName(_by_block(wanted, rows, spots, names.where("several")))
    level, finished = 0, []
    current = settle(_in_order(found), "level")
    while True:
        finished.append(
            current.where("size(names) = 1").select("row", F.lit(level).alias("level"), F.col("names")[0].alias("name"))
        )
        longer = current.where("size(names) > 1")
        if longer.isEmpty():
            break
        current, level = settle(_next_level(longer), "level"), level + 1
    named = finished[0]
    for more in finished[1:]:
        named = named.unionByName(more)
    known = settle(rows.drop("hashes").join(named, "row"), "known")
    groups = settle(
        known.groupBy("level", "name").agg(
            F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("group_size")
        ),
        "groups",
    )
    return known.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("last.row")).alias("kept"),
        "text_sha256",
    )


def _by_block(wanted: DataFrame, rows: DataFrame, spots: DataFrame, names: DataFrame) -> DataFrame:
    """Names of the blocks whose hash several blocks have, found by the blocks themselves."""
    doubtful = spots.join(names.select("hash").distinct(), "hash").select("row", "spot")
    asked = doubtful.join(rows.select("row", F.col("doc_id").alias("of"), "text_sha256"), "row")
    blocks = (
        wanted.join(asked, F.col("doc_id").eqNullSafe(F.col("of")))
        .select("row", "text_sha256", "spot", "text")
        .mapInArrow(_blocks_at, "row long, spot int, block binary")
        .dropDuplicates(["row", "spot"])  # rows that repeat a doc_id and its text
    )
    return blocks.join(names.select("block", "name"), "block").select("row", "spot", "name")


def _in_order(found: DataFrame) -> DataFrame:
    """row, spot, name -> row and its names in order. A row is one document's names."""
    return found.groupBy("row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("spot", "name"))), lambda x: x["name"]).alias("names")
    )


def _next_level(longer: DataFrame) -> DataFrame:
    """Neighbouring names become one name; -1 stands for no neighbour."""
    pairs = settle(
        longer.select("row", F.size("names").alias("n"), "names")
        .select(
            "row",
            F.posexplode(
                F.expr(
                    "transform(sequence(0, n - 1, 2), i -> struct(names[i] AS a, if(i + 1 < n, names[i + 1], -1L) AS b))"
                )
            ).alias("spot", "pair"),
        )
        .select("row", "spot", "pair.a", "pair.b"),
        "pairs",
    )
    names = settle(
        pairs.select("a", "b").distinct().orderBy("a", "b").withColumn("name", F.monotonically_increasing_id()), "names"
    )
    return _in_order(pairs.join(names, ["a", "b"]).select("row", "spot", "name"))
