"""Connected components of an edge table, by rounds of DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.sources.scratch import settle


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns a, b: long).

    ``component`` is the smallest node that can be reached. Each round links the
    larger neighbours of every node to its smallest one, then the smaller ones
    likewise, until only stars are left; the number of rounds grows with the
    logarithm of the graph's size. Every round is a written table. A node that
    a third of all edges share is one row where neighbours are looked up, and
    the other side of that join may be split.
    """
    stars = settle(_ordered(edges.select("a", "b")), "edges")
    mark = _mark(stars)
    while True:
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = settle(both.groupBy("a").agg(F.min("b").alias("least")), "least").select(
            F.col("a").alias("node"), F.least("a", "least").alias("least")
        )
        large = settle(
            _ordered(
                both.join(least, both.a == least.node)
                .where("b > a")
                .select("least", F.col("b").alias("other"))
                .toDF("a", "b")
            ),
            "large",
        )
        least = settle(large.groupBy("a").agg(F.min("b").alias("least")), "least").select(
            F.col("a").alias("node"), "least"
        )
        small = large.join(least, large.a == least.node).select(
            F.explode(F.array(F.struct("a", "least"), F.struct(F.col("b").alias("a"), "least"))).alias("e")
        )
        stars = settle(_ordered(small.select("e.a", "e.least").toDF("a", "b")), "stars")
        now = _mark(stars)
        if now == mark:
            break
        mark = now
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, larger node first, without loops."""
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Tells whether two edge tables hold the same edges."""
    hashes = [F.xxhash64(*c).cast("decimal(20,0)") for c in (("a", "b"), ("b", "a"))]
    return tuple(edges.agg(F.count(F.lit(1)), *map(F.sum, hashes)).first())
