"""Row numbers, NTILE, ranks and running sums over a whole table.

A window without PARTITION BY moves the whole table to one task. Here the table
is settled first, so that its row count is known without recomputing it. Then the
rows are range-sorted on the sort key *including a unique tie breaker* (so a
value shared by a third of the rows still spreads over partitions), numbered
inside each partition, and shifted by the sum of the partitions before it. The
only small side is one row per partition. It is done so for any number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from shopgrain.sources.scratch import settle

_PART, _POS = "__part", "__pos"
_ROW, _BLOCK = "__rn", "__block"
#: Rows of one block of ``frames``, the largest group that one of its windows sorts.
BLOCK = 100_000


class GlobalOrder:
    """A settled table to which whole-table window columns are added."""

    def __init__(self, df: DataFrame, *, _settled: tuple[DataFrame, int] | None = None):
        if _settled:
            self.df, self.rows = _settled
        else:
            self.df = settle(df, "ordered")
            self.rows = self.df.count()  # answered from the file footers

    def _next(self, df: DataFrame) -> "GlobalOrder":
        return GlobalOrder(df, _settled=(df, self.rows))

    # -- distributed building blocks ------------------------------------

    def _sorted(self, order: Sequence[Column]) -> DataFrame:
        """Range-sorted copy with partition number and position inside it.

        Settled, because two reads of an unsettled range sort may sample
        different range bounds.
        """
        numbered = self.df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id())
        return settle(
            numbered.withColumn(_PART, F.shiftright("__id", 33).cast("int"))
            .withColumn(_POS, F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("__id"),
            "sorted",
        )

    @staticmethod
    def _offsets(ranged: DataFrame, *sums: str) -> DataFrame:
        """Per partition: what the partitions before it add up to.

        One row per sort partition, which the shuffle setting bounds.
        """
        per = ranged.groupBy(_PART).agg(
            F.count(F.lit(1)).alias("__n"), *[F.sum(s).alias(f"__s_{s}") for s in sums]
        )
        before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
        return per.select(
            _PART,
            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n_before"),
            *[
                F.coalesce(F.sum(f"__s_{s}").over(before), F.lit(0)).alias(f"__before_{s}")
                for s in sums
            ],
        )

    def _with_number(self, order: Sequence[Column], name: str) -> DataFrame:
        ranged = self._sorted(order)
        return (
            ranged.join(F.broadcast(self._offsets(ranged)), _PART)
            .withColumn(name, F.col("__n_before") + F.col(_POS) + 1)
            .drop(_PART, _POS, "__n_before")
        )

    # -- columns --------------------------------------------------------

    def row_number(self, order: Sequence[Column], name: str) -> "GlobalOrder":
        """1..n. ``order`` must end in a unique column."""
        return self._next(self._with_number(order, name))

    def ntile(self, k: int, order: Sequence[Column], name: str) -> "GlobalOrder":
        """NTILE(k). ``order`` must end in a unique column."""
        size, extra = divmod(self.rows, k)
        # The first `extra` tiles hold size + 1 rows, the others size rows.
        wide_rows = extra * (size + 1)
        n0 = F.col("__rn") - 1
        tile = F.when(n0 < wide_rows, F.floor(n0 / F.lit(size + 1))).otherwise(
            extra + F.floor((n0 - wide_rows) / F.lit(max(size, 1)))
        )
        out = self._with_number(order, "__rn").withColumn(name, (tile + 1).cast("int")).drop("__rn")
        return self._next(out)

    def rank(self, value: str, name: str, *unique: str) -> "GlobalOrder":
        """RANK() over ``value`` descending: the first row number of each value.

        ``unique`` names columns that tell equal values apart.
        """
        numbered = self._with_number([F.col(value).desc(), *map(F.col, unique)], "__rn")
        first = numbered.groupBy(F.col(value).alias("__value")).agg(
            F.min("__rn").cast("int").alias(name)
        )
        # A value that many rows share is one row on the `first` side, so the
        # adaptive skew join may split the other side freely.
        out = numbered.join(first, numbered[value].eqNullSafe(first["__value"])).drop(
            "__value", "__rn"
        )
        return self._next(out)

    def total(self, value: str):
        """The sum of a column, as a value: one row read from the settled table."""
        return self.df.agg(F.sum(value)).first()[0]

    def running_sum(
        self, value: str, order: Sequence[Column], name: str, number: str = "row_number"
    ) -> "GlobalOrder":
        """Sum of ``value`` from the first row of ``order`` to this one, and the row's number."""
        upto = (Window.unboundedPreceding, Window.currentRow)
        ranged = self._sorted(order)
        local = F.sum(value).over(Window.partitionBy(_PART).orderBy(_POS).rowsBetween(*upto))
        out = (
            ranged.join(F.broadcast(self._offsets(ranged, value)), _PART)
            .withColumn(name, F.col(f"__before_{value}") + local)
            .withColumn(number, F.col("__n_before") + F.col(_POS) + 1)
            .drop(_PART, _POS, "__n_before", f"__before_{value}")
        )
        return self._next(out)

    def next_in_group(
        self, keys: Sequence[str], order: Sequence[str], value: str, name: str
    ) -> "GlobalOrder":
        """LEAD(value) inside ``keys``, for groups of any size."""
        ranged = self._sorted([*map(F.col, keys), *map(F.col, order)])
        head = F.struct(*keys, F.col(value).alias("__value"))
        heads = ranged.groupBy(_PART).agg(F.min_by(head, _POS).alias("__head"))
        following = heads.select(_PART, F.lead("__head").over(Window.orderBy(_PART)).alias("__head"))
        inside = F.lead(head).over(Window.partitionBy(_PART).orderBy(_POS))
        seen = ranged.join(F.broadcast(following), _PART).withColumn(
            "__next", F.coalesce(inside, F.col("__head"))
        )
        same = [F.col(k).eqNullSafe(F.col(f"__next.{k}")) for k in keys]
        cond = same[0]
        for c in same[1:]:
            cond = cond & c
        out = seen.withColumn(name, F.when(cond, F.col("__next.__value"))).drop(
            _PART, _POS, "__head", "__next"
        )
        return self._next(out)

    def frames(
        self,
        keys: Sequence[str],
        order: Sequence[str],
        behind: int,
        columns: Callable[[WindowSpec], dict[str, Column]],
        block: int = BLOCK,
    ) -> "GlobalOrder":
        """Window columns that look at most ``behind`` rows back inside ``keys``, for groups of any size.

        ``keys`` and ``order`` must tell all rows apart. The rows are numbered and cut into
        blocks of ``block``; the last ``behind`` rows of a block go to the next one too, where
        they are seen and then dropped. So a group of a third of all rows is
        sorted by many tasks, and each has the rows its frames need. ``columns``
        gets the window and may use lags and frames of up to ``behind`` rows.
        """
        if not 0 < behind <= block:
            raise ValueError("behind must lie between 1 and the size of a block")
        numbered = self._with_number([*map(F.col, keys), *map(F.col, order)], _ROW)
        place = F.col(_ROW) - 1
        home = F.floor(place / F.lit(block))
        is_last = place % block >= block - behind
        homes = F.when(is_last, F.array(home, home + 1)).otherwise(F.array(home))
        window = Window.partitionBy(_BLOCK, *keys).orderBy(_ROW)
        out = (
            numbered.withColumn(_BLOCK, F.explode(homes))
            .select("*", *[c.alias(n) for n, c in columns(window).items()])
            .where(F.col(_BLOCK) == home)
            .drop(_BLOCK, _ROW)
        )
        return self._next(out)
