"""Exact search for the highest inner products with ball trees.

Vectors become integers and are dealt by hash into shards of about ``SHARD_CELLS``
numbers. Each shard is a ball tree; a node's ball bounds the inner product of a
query with all its points: query . centre + |query| * radius, and no more than its
parent's bound. Queries come in blocks. A block first searches one shard, and the
k-th score each query finds there is the bar with which it searches all others;
inside a shard leaves are met in the order of their bounds, the bar rises as points
are found, and a query stops where the next bound is under its bar. Every pair of
a block and a shard is one row of a join on their numbers, so neither all queries
nor all vectors are ever in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopgrain.sources.scratch import settle

K, EVERY, SCALE = 20, 20, 64
SHARD_CELLS, LEAF, BLOCK = 1 << 19, 64, 512
_EXACT = float(1 << 53)
_TREE = "size int, shard long, points binary, rows binary, ids binary, leaves binary, centres binary, radii binary, parents binary"


def whole(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """id, row, size, point (floor(scale * x) of each component) of all vectors that take part."""
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
        .where(F.col("id").isNotNull() & F.col("v").isNotNull() & ok)
        .select(
            "id",
            F.monotonically_increasing_id().alias("row"),
            F.size("v").alias("size"),
            F.transform("v", lambda x: F.floor(x * scale)).alias("point"),
        )
    )


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), size)


def _narrow(numbers: np.ndarray) -> bytes:
    """The numbers in the narrowest integers that hold them all."""
    for kind in (np.int8, np.int16, np.int32):
        if not numbers.size or np.abs(numbers).max() <= np.iinfo(kind).max and numbers.min() > np.iinfo(np.int64).min:
            return numbers.astype(kind).tobytes()
    return numbers.tobytes()


def _wide(data: bytes, rows: int, size: int) -> np.ndarray:
    kind = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}[len(data) // (rows * size) if data else 8]
    return np.frombuffer(data, kind).reshape(rows, size)


def ball_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The order of the points by leaf; each leaf's (start, end, node); centre, radius and parent of each node."""
    near = points.astype(np.float64)
    order, leaves, centres, radii, parents = [], [], [], [], []
    open_nodes = [(np.arange(len(points)), -1)]
    while open_nodes:
        own, parent = open_nodes.pop()
        node, part = len(centres), near[own]
        centre = part.mean(axis=0) if len(own) else np.zeros(points.shape[1])
        away = np.sqrt(((part - centre) ** 2).sum(axis=1))
        centres.append(centre)
        radii.append(away.max(initial=0.0))
        parents.append(parent)
        if len(own) <= LEAF or radii[-1] == 0:
            start = sum(map(len, order)) if not leaves else leaves[-1][1]
            order.append(own)
            leaves.append((start, start + len(own), node))
            continue
        a = part[away.argmax()]
        b = part[((part - a) ** 2).sum(axis=1).argmax()]
        side = part @ (b - a)
        right = side > np.median(side)
        if not right.any():  # the median is the highest value
            right = side == side.max()
            if right.all():
                right = np.arange(len(own)) % 2 == 0
        open_nodes += [(own[right], node), (own[~right], node)]
    return (
        np.concatenate(order),
        np.array(leaves, np.int64),
        np.array(centres, np.float64),
        np.array(radii, np.float64),
        np.array(parents, np.int64),
    )


def _build(table: pa.Table) -> pa.Table:
    size = table.column("size")[0].as_py()
    rows = table.column("row").to_numpy()
    sort = np.argsort(rows, kind="stable")
    points = _matrix(table.column("point").combine_chunks(), size)[sort]
    order, leaves, centres, radii, parents = ball_tree(points)
    values = {
        "rows": rows[sort][order],
        "ids": table.column("id").to_numpy()[sort][order],
        "leaves": leaves,
        "centres": centres,
        "radii": radii,
        "parents": parents,
    }
    return pa.table(
        {"size": pa.array([size], pa.int32()), "shard": pa.array([table.column("shard")[0].as_py()], pa.int64())}
        | {"points": pa.array([_narrow(points[order])], pa.binary())}
        | {k: pa.array([v.tobytes()], pa.binary()) for k, v in values.items()}
    )


def _block(table: pa.Table) -> pa.Table:
    size = table.column("size")[0].as_py()
    return pa.table(
        {
            "size": pa.array([size], pa.int32()),
            "block": pa.array([table.column("block")[0].as_py()], pa.int64()),
            "queries": pa.array([_narrow(_matrix(table.column("point").combine_chunks(), size))], pa.binary()),
            "query_rows": pa.array([table.column("row").to_numpy().tobytes()], pa.binary()),
            "query_ids": pa.array([table.column("id").to_numpy().tobytes()], pa.binary()),
            "bars": pa.array([table.column("bar").to_numpy(zero_copy_only=False).astype(np.float64).tobytes()], pa.binary()),
        }
    )


def search(
    queries: np.ndarray, query_rows: np.ndarray, bars: np.ndarray, tree: dict[str, np.ndarray], k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and scores of up to ``k`` points, best first, none under its bar."""
    points, rows, ids = tree["points"], tree["rows"], tree["ids"]
    peak = _peak(points) * _peak(queries) * max(points.shape[1], 1)
    exact = peak < _EXACT
    kind = np.float64 if exact else object  # integers of any size
    asked, held = queries.astype(kind), points.astype(kind)
    q = queries.astype(np.float64)
    length = np.sqrt((q**2).sum(axis=1))
    bounds = q @ tree["centres"].T + length[:, None] * tree["radii"][None, :]
    bounds += 1e-9 * (np.abs(bounds) + length[:, None] * (tree["radii"] + np.abs(tree["centres"]).sum(axis=1))) + 1e-6
    for node, parent in enumerate(tree["parents"].tolist()):
        if parent >= 0:
            np.minimum(bounds[:, node], bounds[:, parent], out=bounds[:, node])
    leaves = tree["leaves"]
    bounds = bounds[:, leaves[:, 2]]
    order = np.argsort(-bounds, axis=1, kind="stable")
    best_ids = [np.zeros(0, np.int64)] * len(queries)
    best = [np.zeros(0, kind)] * len(queries)
    bars = bars.copy()
    live = np.arange(len(queries))
    for turn in range(len(leaves)):
        leaf = order[live, turn]
        go_on = bounds[live, leaf] >= bars[live]
        live, leaf = live[go_on], leaf[go_on]
        if not len(live):
            break
        for one in np.unique(leaf).tolist():
            start, end, _ = leaves[one]
            own = live[leaf == one]
            scores = asked[own] @ held[start:end].T
            for i, row in zip(own.tolist(), scores):
                good = (row >= bars[i]) & (rows[start:end] != query_rows[i])
                if not good.any():
                    continue
                all_scores = np.concatenate([best[i], row[good]])
                all_ids = np.concatenate([best_ids[i], ids[start:end][good]])
                top = np.lexsort((all_ids, -all_scores))[:k]
                best[i], best_ids[i] = all_scores[top], all_ids[top]
                if len(top) == k:
                    bars[i] = max(bars[i], float(all_scores[top[-1]]) if exact else _below(all_scores[top[-1]]))
    return list(zip(best_ids, best))


def _peak(numbers: np.ndarray) -> float:
    return float(np.abs(numbers.astype(np.float64)).max(initial=0))


def _below(score: int) -> float:
    """A float that is not above the score."""
    return float(np.nextafter(float(score), -np.inf))


def _searched(k: int):
    kinds = {"rows": np.int64, "ids": np.int64, "leaves": np.int64, "centres": np.float64, "radii": np.float64, "parents": np.int64}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                get = lambda name: batch.column(name)[at].as_py()  # noqa: B023, E731
                size = get("size")
                tree = {n: np.frombuffer(get(n), kind) for n, kind in kinds.items()}
                rows = len(tree["rows"])
                tree |= {
                    "points": _wide(get("points"), rows, size),
                    "leaves": tree["leaves"].reshape(-1, 3),
                    "centres": tree["centres"].reshape(len(tree["radii"]), size),
                }
                query_rows, query_ids = np.frombuffer(get("query_rows"), np.int64), np.frombuffer(get("query_ids"), np.int64)
                queries = _wide(get("queries"), len(query_rows), size)
                found = search(queries, query_rows, np.frombuffer(get("bars"), np.float64), tree, k)
                sizes = [len(i) for i, _ in found]
                scores = [min(max(int(s), -(1 << 63)), (1 << 63) - 1) for _, ss in found for s in ss]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(query_rows, sizes)),
                        pa.array(np.repeat(query_ids, sizes)),
                        pa.array(np.concatenate([i for i, _ in found]), pa.int64()),
                        pa.array(scores, pa.int64()),
                    ],
                    ["query_row", "query_id", "vec_id", "score"],
                )

    return task


def top_inner_products(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = K,
    every: int = EVERY,
    scale: int = SCALE,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` highest inner products of each query, or all if fewer.

    Vectors are floor(scale * x) of each component. Queries are the rows whose id
    is divisible by ``every``; candidates are all rows but the query's own. Equal
    scores go by the smaller id. Rows with a null id, a null vector or a vector
    with null or non-finite components take no part; vectors of different lengths
    are not compared; the empty vector scores 0 with others of its kind. A repeated
    row is a row of its own, as a query too, so ranks of an id that is there twice
    appear twice. Scores beyond 64 bits are shown as the nearest 64-bit number.
    An empty table gives no rows; other columns are not read.
    """
    rows = settle(whole(vectors, vec_id, embedding, scale), "vectors")
    asks = F.col("id") % every == 0
    counts = rows.groupBy("size").agg(
        F.ceil(F.count(F.lit(1)) * F.greatest("size", F.lit(1)) / F.lit(SHARD_CELLS)).alias("shards"),
        F.ceil(F.count(F.when(asks, 1)) / F.lit(BLOCK)).alias("blocks"),
    )
    rows = rows.join(settle(counts, "sizes"), "size")
    trees = settle(
        rows.select("size", "row", "id", "point", F.pmod(F.xxhash64("row"), F.col("shards")).alias("shard"))
        .groupBy("size", "shard")
        .applyInArrow(_build, _TREE),
        "trees",
    )
    queries = rows.where(asks).select(
        "size", "row", "id", "point", "shards", F.pmod(F.xxhash64("row", F.lit(1)), F.col("blocks")).alias("block")
    )
    kind = "size int, block long, queries binary, query_rows binary, query_ids binary, bars binary"
    sizes = rows.select("size", "shards", "blocks").distinct()

    def pairs(asking: DataFrame, first: bool) -> DataFrame:
        """Blocks of queries beside the trees they are to search."""
        blocks = asking.groupBy("size", "block").applyInArrow(_block, kind).join(sizes, "size")
        home = F.pmod(F.col("block"), F.col("shards"))
        others = F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)
        own = blocks.withColumn("shard", home if first else F.explode(F.array_except(others, F.array(home)))).drop("shards", "blocks")
        wanted = own.select("size", "block", "shard").distinct()
        return own.join(trees.join(wanted, ["size", "shard"]), ["size", "shard", "block"])

    out = "query_row long, query_id long, vec_id long, score long"
    at_home = settle(pairs(queries.withColumn("bar", F.lit(float("-inf"))), True).mapInArrow(_searched(k), out), "home")
    bars = (
        at_home.groupBy("query_row")
        .agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
        .select("query_row", F.when((F.col("n") >= k) & (F.abs("least") < int(_EXACT)), F.col("least").cast("double")).alias("bar"))
    )
    informed = queries.join(bars.withColumnRenamed("query_row", "row"), "row", "left").fillna(float("-inf"), ["bar"])
    away = pairs(informed, False).mapInArrow(_searched(k), out)
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return (
        at_home.unionByName(away)
        .withColumn("rank", place)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
