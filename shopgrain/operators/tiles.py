"""NTILE over whole tables in several orders at once, without a sort.

NTILE needs only the rows at which its tiles begin. Their values are found by counting:
the interval in which a border lies is cut into bins, the rows of each bin are counted,
and the bin that holds the border's rank is the next interval. All borders of all orders
share each pass over the table, and ties go on to the next column of the order in the same way.
The tile of a row is then a comparison with the borders, so the table is neither shuffled
nor written for it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.sources.scratch import settle

#: Bins of one interval. A pass hands the driver at most this many counts for each border.
BINS = 4096
# Differences of numbers below this stay within a long.
_SAFE = 1 << 61

Order = Sequence[tuple[str, bool]]


@dataclass(frozen=True)
class _Level:
    """One whole number of an order: ascending, never null, with its bounds over the table."""

    value: Column
    kind: str
    low: int
    high: int

    def lit(self, number: int) -> Column:
        return F.lit(Decimal(number)).cast(self.kind)


@dataclass
class _Border:
    """A sought row: ``rank`` rows of the interval, under the values found so far, come before it."""

    order: str
    rank: int
    found: tuple[int, ...]
    low: int
    high: int

    @property
    def interval(self) -> tuple:
        return self.order, self.found, self.low, self.high


def _whole(df: DataFrame, name: str) -> Column:
    """A column as whole numbers; decimals in units of their last digit."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DecimalType):
        if kind.scale > 6:
            raise TypeError(f"{name}: more than six digits behind the point")
        return (F.col(name) * F.lit(10**kind.scale)).cast("decimal(38,0)")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("long")
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("long")
    raise TypeError(f"{name}: {kind.simpleString()} is no whole number, decimal or date")


def _levels(df: DataFrame, orders: Mapping[str, Order]) -> tuple[int, dict[str, list[_Level]]]:
    """The row count, and per order its levels: of each column whether it is null, then its value."""
    names = sorted({c for order in orders.values() for c, _ in order})
    bounds = df.agg(
        F.count(F.lit(1)),
        *[f(x) for c in names for x in (_whole(df, c),) for f in (F.min, F.max, F.count)],
    ).first()
    rows, held = bounds[0], {c: bounds[1 + 3 * i : 4 + 3 * i] for i, c in enumerate(names)}

    def levels(name: str, descending: bool) -> list[_Level]:
        low, high, filled = held[name]
        if not filled:
            return []
        # Spark's order: nulls are first in ascending order, last in descending order.
        is_null, low, high = F.col(name).isNull(), int(low), int(high)
        flag = _Level((is_null if descending else ~is_null).cast("long"), "long", 0, 1)
        kind = "long" if max(-low, high) < _SAFE else "decimal(38,0)"
        value = F.coalesce(_whole(df, name).cast(kind), F.lit(Decimal(low)).cast(kind))
        if descending:
            value, low, high = -value, -high, -low
        return [*([flag] if filled < rows else []), _Level(value.cast(kind), kind, low, high)]

    return rows, {n: [x for c, down in order for x in levels(c, down)] for n, order in orders.items()}


def _within(levels: Sequence[_Level], interval: tuple) -> Column:
    _, found, low, high = interval
    level = levels[len(found)]
    same = [x.value == x.lit(v) for x, v in zip(levels, found)]
    return reduce(Column.__and__, same, level.value.between(level.lit(low), level.lit(high)))


def _counts(df: DataFrame, levels: Mapping[str, Sequence[_Level]], intervals: Sequence[tuple]) -> dict:
    """Per interval its bins with rows, in order: (bin, rows)."""
    cells = []
    for number, interval in enumerate(intervals):
        order, found, low, high = interval
        level = levels[order][len(found)]
        offset = level.value - level.lit(low)
        bin_ = F.call_function("div", offset, level.lit(_width(low, high))).cast("int")
        cells.append(
            F.when(
                _within(levels[order], interval),
                F.struct(F.lit(number).alias("interval"), bin_.alias("bin")),
            )
        )
    counted = (
        df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell"))
        .groupBy("cell.interval", "cell.bin")
        .count()
        .collect()
    )
    out: dict = {interval: [] for interval in intervals}
    for r in sorted(counted):
        out[intervals[r[0]]].append((r[1], r[2]))
    return out


def _width(low: int, high: int) -> int:
    return -(-(high - low + 1) // BINS)


def _settled(border: _Border, levels: Sequence[_Level]) -> bool:
    """Move on over all columns whose value is found; whether none is left."""
    while len(border.found) < len(levels) and border.low == border.high:
        border.found += (border.low,)
        if len(border.found) < len(levels):
            border.low, border.high = levels[len(border.found)].low, levels[len(border.found)].high
    return len(border.found) == len(levels)


def _narrow(border: _Border, bins: Sequence[tuple[int, int]]) -> None:
    width, low = _width(border.low, border.high), border.low
    for number, rows in bins:
        if border.rank < rows:
            border.low = low + number * width
            border.high = min(border.high, border.low + width - 1)
            return
        border.rank -= rows
    raise AssertionError("the table changed between two passes")


def _from(levels: Sequence[_Level], found: Sequence[int]) -> Column:
    """Whether a row is the border or comes after it."""
    reached = F.lit(True)
    for level, value in reversed(list(zip(levels, found))):
        reached = (level.value > level.lit(value)) | ((level.value == level.lit(value)) & reached)
    return reached


def add_tiles(df: DataFrame, k: int, orders: Mapping[str, Order]) -> DataFrame:
    """``df`` with NTILE(k) of each order, under the order's name.

    An order lists columns and whether each is descending, and must tell all rows apart;
    rows it cannot tell apart get one tile. Columns are whole numbers, decimals of at most
    six digits behind the point, or dates. The table is written once, as it is read
    several times: a column whose values span n units takes about log2(n) / 12 passes.
    """
    df = settle(df, "tiled")
    rows, levels = _levels(df, orders)
    size, extra = divmod(rows, k)
    starts = [t * size + min(t, extra) for t in range(1, k)]
    borders = [
        _Border(name, start, (), own[0].low, own[0].high)
        for name, own in levels.items()
        if own
        for start in starts
        if start < rows
    ]
    sought = [b for b in borders if not _settled(b, levels[b.order])]
    while sought:
        bins = _counts(df, levels, sorted({b.interval for b in sought}))
        for border in sought:
            _narrow(border, bins[border.interval])
        sought = [b for b in sought if not _settled(b, levels[b.order])]
    tiles = {}
    for name, own in levels.items():
        passed = [_from(own, b.found).cast("int") for b in borders if b.order == name]
        tiles[name] = reduce(Column.__add__, passed, F.lit(1))
    return df.withColumns(tiles)
