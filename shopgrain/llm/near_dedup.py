"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

The sketch of a shingle set has ``T`` coordinates. In round i < T every shingle
is thrown into a random coordinate with a random value, the smallest value stays;
in round i >= T all shingles are thrown into coordinate i - T. Rounds go on until
every coordinate is filled, and values of later rounds are larger, so two sets
agree in a coordinate with the probability of their Jaccard similarity, and the
share of equal coordinates is concentrated around it, also for small sets. The
coordinates are cut into ``BANDS`` bands of ``ROWS`` rows; documents that share a
band are candidates. A pair at similarity 0.85 shares none with probability 3e-6.

Candidates are confirmed on their full sets. Equal sets are one class from the
start, so copies cost nothing later. Classes that candidates connect are compared
block by block: a block holds at most ``BLOCK_SETS`` classes and about
``BLOCK_SHINGLES`` shingles, and each pair of blocks is one task, however many
classes hang together. A task hands on a spanning forest of the links it has
confirmed instead of all pairs; components stay the same by that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.arrow import lists, slices, small_batches, text_bytes
from shopgrain.llm.graph import components
from shopgrain.llm.sieve import sieved
from shopgrain.llm.text import mix, shingles, word_hashes
from shopgrain.sources.scratch import settle

WORDS = 5
BANDS, ROWS = 40, 8
T = BANDS * ROWS
BLOCK_SETS, BLOCK_SHINGLES = 128, 1_000_000
CHUNK_SHINGLES = 200_000

_SEEDS = mix(np.arange(1, 2 * T + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``T`` coordinates for each of the (not empty) sets."""
    out = np.full((len(sets), T), _EMPTY, dtype=np.uint64)
    flat, low = out.reshape(-1), np.uint64((1 << 40) - 1)
    live = np.arange(len(sets))
    for i in range(2 * T):
        if not len(live):
            break
        if i == 0 or len(live) < still:
            still = len(live)
            sizes = [len(sets[k]) for k in live]
            values = np.concatenate([sets[k] for k in live])
            starts = np.repeat(live * T, sizes)
        x = mix(values ^ _SEEDS[i])
        if i < T:
            place = starts + (((x >> np.uint64(40)) * np.uint64(T)) >> np.uint64(24)).astype(np.int64)
        else:
            place = starts + (i - T)
        np.minimum.at(flat, place, (x & low) | np.uint64(i << 40))
        if i < 4 or i % 4 == 0:
            live = live[(out[live] == _EMPTY).any(axis=1)]
    return out


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """The keys of all bands of each set, the band's number hashed in."""
    rows = sketch(sets).reshape(len(sets), BANDS, ROWS)
    keys = (rows * _FACTORS).sum(axis=2, dtype=np.uint64)
    return mix(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _signature(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ids, text -> ids, text_hash, n_shingles, sig_a, sig_b, bands."""
    for batch in slices(batches):
        n, found, sizes, signs = batch.num_rows, [], np.zeros(batch.num_rows, np.int64), []
        bands = np.zeros((n, BANDS), np.int64)

        def flush():
            if found:
                bands[[r for r, _ in found]] = band_keys([s for _, s in found])
                found.clear()

        held = 0
        for row, words in word_hashes(text_bytes(batch.column("text"))):
            values = shingles(words, WORDS)
            sizes[row] = len(values)
            signs.append(_signature(values))
            if len(values):
                found.append((row, values))
                held += len(values)
                if held > CHUNK_SHINGLES:
                    flush()
                    held = 0
        flush()
        pair = np.frombuffer(b"".join(signs), np.int64).reshape(n, 2)
        full = sizes > 0
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array(sizes),
                pa.array(np.ascontiguousarray(pair[:, 0])),
                pa.array(np.ascontiguousarray(pair[:, 1])),
                lists(bands[full].reshape(-1), full * BANDS, pa.int64()),
            ],
            ["doc_id", "text_hash", "n_shingles", "sig_a", "sig_b", "bands"],
        )


def confirmed(ids: np.ndarray, left: np.ndarray, sets: list[np.ndarray], share: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets of the left and of the right block.

    ``left`` tells each set's side (0, 1; 2 is both). Two sets are linked when
    100 * intersection >= ``share`` * union. Intersections are products of 0/1
    matrices over the shingles that two sets share at all, a few thousand
    columns at a time.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    owner, column = owner[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((n, n), dtype=np.float64)
    step = 4096
    for first in range(0, int(shared.sum()), step):
        a, b = np.searchsorted(column, (first, first + step))
        part = np.zeros((n, step), dtype=np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    links = 100 * common >= share * union
    links &= (left[:, None] != left[None, :]) | (left[:, None] == 2)
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    forest = []
    for i, j in zip(*np.nonzero(np.triu(links, 1))):
        a, b = root(int(i)), root(int(j))
        if a != b:
            parent[a] = b
            forest.append((int(ids[i]), int(ids[j])))
    return forest


def _links(share: int):
    def task(table: pa.Table) -> pa.Table:
        first, second = table.column("first")[0].as_py(), table.column("second")[0].as_py()
        ids, place = np.unique(table.column("class").to_numpy(), return_index=True)  # repeated rows go
        home = table.column("home").to_numpy()[place]
        side = np.where(home == first, 0, 1) if first != second else np.full(len(ids), 2)
        column = table.column("shingles")
        sets = [np.frombuffer(column[int(p)].as_py(), np.uint64) for p in place]
        pairs = confirmed(ids, side, sets, share)
        return pa.table(
            {"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())}
        )

    return task


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = 85
) -> DataFrame:
    """One row per document: its shingle count and the component of linked documents it belongs to.

    Words are runs of characters other than 0x20 and 0x09-0x0D, A-Z as a-z; a
    document's set holds its distinct runs of five words, or the whole as one if
    it has fewer. Sets are compared by 64-bit hashes of their shingles.

    Result: doc_id, text_hash (xxhash64 of the text), n_shingles, component (a
    number of the component; null for an empty set), component_id (smallest doc_id
    reachable, itself included), kept (doc_id = component_id).
    Null and empty texts have an empty set, are linked with nothing and are their
    own component. Null doc_ids count as larger than any other; a component of
    them alone has the id null, and its rows are kept. Repeated rows are all
    kept or all not: the operator decides by document. An empty table gives no
    rows. Other columns of ``docs`` are not read.
    """
    wanted = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash")
    )
    id_type = wanted.schema["doc_id"].dataType.simpleString()
    with small_batches(docs.sparkSession):
        marks = settle(
            wanted.mapInArrow(
                _sketched,
                f"doc_id {id_type}, text_hash long, n_shingles long, sig_a long, sig_b long, bands array<long>",
            ),
            "sketches",
        )
    classes = settle(
        marks.where("n_shingles > 0")
        .groupBy("sig_a", "sig_b")
        .agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"))
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    # Of a class, the rows of its smallest doc_id bring the bands.
    heads = classes.select(F.col("sig_a").alias("a"), F.col("sig_b").alias("b"), F.col("doc_id").alias("least"), "class")
    same = (F.col("sig_a") == F.col("a")) & (F.col("sig_b") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("least"))
    keys = settle(marks.join(heads, same).select("class", F.explode("bands").alias("key")), "keys")
    least = settle(
        keys.groupBy("key").agg(F.min("class").alias("least"), F.max("class").alias("most")).where("least <> most"),
        "buckets",
    )
    candidates = settle(
        keys.join(least.select("key", "least"), "key")
        .where("class <> least")
        .select(F.col("class").alias("a"), F.col("least").alias("b"))
        .distinct(),
        "candidates",
    )
    groups = settle(components(candidates), "groups").toDF("class", "group")
    with small_batches(docs.sparkSession):
        linked = settle(_verify(wanted, classes, groups, share), "links")
    reached = components(linked).toDF("class", "component")
    named = settle(
        classes.join(reached, "class", "left").withColumn("component", F.coalesce("component", "class")), "named"
    )
    smallest = settle(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "smallest")
    by_class = settle(
        named.join(smallest, "component").select("sig_a", "sig_b", "component", "component_id"),
        "decided",
    )
    out = marks.join(by_class, ["sig_a", "sig_b"], "left").withColumn(
        "component_id", F.when(F.col("component").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    )
    return out.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        "component",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _verify(wanted: DataFrame, classes: DataFrame, groups: DataFrame, share: int) -> DataFrame:
    """Links between the classes that candidates connect, confirmed on full sets."""
    members = groups.join(classes, "class")
    sizes = settle(
        members.groupBy("group").agg(
            F.greatest(
                F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_SETS)), F.ceil(F.sum("n_shingles") / F.lit(BLOCK_SHINGLES))
            ).alias("blocks")
        ),
        "group_sizes",
    )
    members = settle(
        members.join(sizes, "group").select(
            "group", "class", "doc_id", "sig_a", "sig_b", "blocks",
            F.pmod(F.xxhash64("class"), F.col("blocks")).alias("home"),
        ),
        "members",
    )
    spread = members.select(
        "class", "sig_a", "sig_b", F.col("doc_id").alias("least"),
        F.struct("group", "home").alias("home"), "blocks",
    )
    sets = (
        sieved(wanted.select("doc_id", "text"), members, "doc_id")
        .join(spread, F.col("doc_id").eqNullSafe(F.col("least")))
        .select("class", "sig_a", "sig_b", F.col("home.group").alias("group"), F.col("home.home").alias("home"), "blocks", "text")
    )
    return _pairs_of_blocks(sets, share)


def _pairs_of_blocks(sets: DataFrame, share: int) -> DataFrame:
    """Every pair of a group's blocks, a block with itself included, is one task's group."""
    ready = sets.mapInArrow(
        _grouped_sets, "class long, group long, home long, blocks long, shingles binary"
    )
    first, second = F.least("home", "other"), F.greatest("home", "other")
    return (
        ready.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("class", "group", "home", first.alias("first"), second.alias("second"), "shingles")
        .groupBy("group", "first", "second")
        .applyInArrow(_links(share), "a long, b long")
    )


def _grouped_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """class, sig_a, sig_b, group, home, blocks, text -> class, group, home, blocks, shingles.

    Rows whose text is not that of the class, though the doc_id is, are left out.
    """
    for batch in slices(batches):
        sets = [shingles(words, WORDS) for _, words in word_hashes(text_bytes(batch.column("text")))]
        pair = np.frombuffer(b"".join(map(_signature, sets)), np.int64).reshape(len(sets), 2)
        same = (pair[:, 0] == batch.column("sig_a").to_numpy()) & (pair[:, 1] == batch.column("sig_b").to_numpy())
        columns = [batch.column(c) for c in ("class", "group", "home", "blocks")]
        columns.append(pa.array([s.tobytes() for s in sets], pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, ["class", "group", "home", "blocks", "shingles"]).filter(pa.array(same))
