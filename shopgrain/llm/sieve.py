"""A cheap look at whether a key can be in another table, before whole texts are shuffled to find it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the sieve. Its table has at most BITS / 64 rows of two longs, however many keys there are.
BITS = 1 << 25


def sieved(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``rows`` whose ``key`` is in ``keys``, and some others; null is a key like any other.

    A key sets one bit by its hash. The bits are combined in the map tasks and
    broadcast: 8 MB at most. With more keys than bits most rows pass, and the join
    that follows decides as it does with few.
    """
    place = F.pmod(F.xxhash64(key), F.lit(BITS))
    bits = (
        keys.select(place.alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 AS int))")).alias("bits"))
    )
    names = rows.columns
    return (
        rows.withColumn("__place", place)
        .join(F.broadcast(bits), F.shiftright("__place", 6) == F.col("word"))
        .where(F.expr("bits & shiftleft(1L, cast(__place % 64 AS int)) <> 0"))
        .select(*names)
    )
