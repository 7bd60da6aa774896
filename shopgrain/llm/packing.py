"""Packing of documents into windows of a fixed length, best fit decreasing.

A document's ids are cut into full windows; what is left over is a piece shorter
than a window. The pieces go, longest first, into the open window with the least
room that still holds them; a segment tree over the amounts of room finds it. The
left-over pieces of all documents are dealt by hash into shards of about
``SHARD`` pieces, each packed by one task: a window that stays open at the end of
a shard costs a part of one in thousands.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.arrow import by_bytes, lists, small_batches
from shopgrain.llm.vocabulary import (
    WordTable,
    check_word_by_word,
    read_vocabulary,
    simplified,
    split_words,
    token_table,
    vocabulary_path,
)
from shopgrain.sources.scratch import settle

WINDOW = 2048
END_ID = 1
SHARD = 20_000
VOCABULARY = "word_bpe_49k.json"
_PIECE = "piece long, doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long"


class OpenWindows:
    """The open windows by the room they have left, with a segment tree over the rooms."""

    def __init__(self, window: int):
        self.window = window
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.by_room: list[list[int]] = [[] for _ in range(window + 1)]

    def tightest(self, length: int) -> int:
        """The least room of at least ``length`` that an open window has, or -1."""
        count, node = self.count, length + self.leaves
        while not count[node]:
            while node & 1:  # a right child: its parent holds nothing further right
                node >>= 1
                if not node:
                    return -1
            node += 1  # the sibling to the right
            if not node & (node - 1):  # the level is at its end
                return -1
        while node < self.leaves:
            node *= 2
            if not count[node]:
                node += 1
        return node - self.leaves

    def put(self, window_id: int, room: int) -> None:
        self.by_room[room].append(window_id)
        self._change(room, 1)

    def take(self, room: int) -> int:
        self._change(room, -1)
        return self.by_room[room].pop()

    def _change(self, room: int, by: int) -> None:
        node, count = room + self.leaves, self.count
        while node:
            count[node] += by
            node >>= 1


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each piece; ``lengths`` must not rise."""
    windows, numbers, offsets, made = OpenWindows(window), [], [], 0
    for length in lengths:
        room = windows.tightest(length)
        if room < 0:
            number, room, made = made, window, made + 1
        else:
            number = windows.take(room)
        numbers.append(number)
        offsets.append(window - room)
        if room > length:
            windows.put(number, room - length)
    return numbers, offsets


def _cut(vocabulary, window: int, end_id: int, with_ids: bool):
    """doc_id, text -> pieces of at most ``window`` ids."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: WordTable = token_table(vocabulary.value)
        piece = TaskContext.get().partitionId() << 40
        for batch in by_bytes(batches, "text"):
            words, edges, distinct = split_words(simplified(batch.column("text")))
            ids, ends = table.rows(table.look_up(distinct)[words])
            ids, edges = ids.astype("<u4", copy=False), ends[edges].tolist()
            doc, starts, lengths, sums, totals, parts = [], [], [], [], [], []
            for row in range(batch.num_rows):
                own = np.append(ids[edges[row] : edges[row + 1]], np.uint32(end_id))
                for start in range(0, len(own), window):
                    part = own[start : start + window]
                    doc.append(row)
                    starts.append(start)
                    lengths.append(len(part))
                    sums.append(zlib.crc32(part))
                    totals.append(len(own))
                    if with_ids:
                        parts.append(part)
            columns = [
                pa.array(np.arange(piece, piece + len(doc))),
                batch.column("doc_id").take(pa.array(doc, pa.int64())),
                *(pa.array(c, pa.int64()) for c in (starts, lengths, sums, totals)),
            ]
            names = ["piece", "doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
                columns.append(lists(flat.astype(np.int32), np.array(lengths, np.int64), pa.int32()))
                names.append("ids")
            piece += len(doc)
            yield pa.RecordBatch.from_arrays(columns, names)

    return task


def _pack_shard(window: int):
    def task(table: pa.Table) -> pa.Table:
        length, piece = table.column("length").to_numpy(), table.column("piece").to_numpy()
        table = table.take(pa.array(np.lexsort((piece, -length))))
        numbers, offsets = best_fit(table.column("length").to_pylist(), window)
        shard = table.column("shard")[0].as_py()
        table = table.append_column("sequence_id", pa.array([(((shard << 32) | n) << 1) | 1 for n in numbers], pa.int64()))
        return table.append_column("offset", pa.array(offsets, pa.int64())).drop_columns(["shard"])

    return task


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of all documents and the place of each in a sequence of at most ``window`` ids.

    A document's ids are those of its whole text by the tokenizer file
    ``vocabulary`` (no special tokens added), then ``end_id``; a null or empty
    text has that id alone. The text is taken word by word, which leaves the ids
    as they are as long as the tokenizer lower-cases, drops white space and splits
    at it and at signs behind letters; a file that cuts a fixed text otherwise is refused.

    Result, a row per piece: doc_id, start (the document's ids before it), length,
    ids_crc32 (of its ids as little-endian unsigned 32-bit numbers), doc_tokens,
    sequence_id, offset (in the sequence, without gaps from 0), padded_length of
    the sequence (its own length if that is a power of two, else ``window``) and,
    with ``with_ids``, ids. Repeated rows are documents of their own, null ids
    stay null, other columns are not read, an empty table gives no rows.
    """
    spark = docs.sparkSession
    wanted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    words = read_vocabulary(vocabulary or vocabulary_path(VOCABULARY))
    check_word_by_word(words)
    shared = spark.sparkContext.broadcast(words)
    kind = _PIECE.format(id=wanted.schema["doc_id"].dataType.simpleString())
    cut = wanted.mapInArrow(_cut(shared, window, end_id, with_ids), kind + (", ids array<int>" if with_ids else ""))
    with small_batches(spark):
        pieces = settle(cut, "pieces")
    short = pieces.drop("ids").where(F.col("length") < window)
    shards = -(-short.count() // SHARD) or 1
    packed = settle(
        short.withColumn("shard", F.pmod(F.xxhash64("piece"), F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(_pack_shard(window), kind + ", sequence_id long, offset long"),
        "packed",
    )
    full = (
        pieces.drop("ids")
        .where(F.col("length") == window)
        .withColumn("sequence_id", F.col("piece") * 2)
        .withColumn("offset", F.lit(0).cast("long"))
        .withColumn("padded_length", F.lit(window).cast("long"))
    )
    sums = packed.groupBy("sequence_id").agg(F.sum("length").alias("filled"))
    power = F.col("filled").bitwiseAND(F.col("filled") - 1) == 0
    padded = packed.join(
        sums.select("sequence_id", F.when(power, F.col("filled")).otherwise(window).cast("long").alias("padded_length")), "sequence_id"
    )
    out = full.unionByName(padded)
    if with_ids:
        out = out.join(pieces.select("piece", "ids"), "piece")
    return out.drop("piece")


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, ids, doc_ids, starts (of the pieces): the windows themselves, from ``pack(..., with_ids=True)``."""
    return (
        pieces.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("held"))
        .select(
            "sequence_id",
            F.flatten(F.col("held.ids")).alias("ids"),
            F.col("held.doc_id").alias("doc_ids"),
            F.col("held.offset").alias("starts"),
        )
    )
