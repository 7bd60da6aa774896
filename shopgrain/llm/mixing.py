"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Every document of a source is to be taken ``target / source_size`` times. Its
whole part is certain; the fraction is a probability, and the fractions of a
source are rounded together: two units meet, one of them takes so much of the
other's mass that one becomes 0 or 1, and the other goes on with the rest. Each
meeting keeps the sum of both, so the number of copies taken stays within one of
its expectation, and each unit keeps its probability. Units meet in the order of
their size, which keeps the taken words near the target as well.

Meetings form a tree: ``FAN`` neighbours of the order are one group, folded in one
row, and of each group one unit with a fraction goes on to the next level, until
a source has one left; that one is rounded by itself. A source of any size is
spread over n / FAN groups. Chance is a hash of the units that meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.order import numbered
from shopgrain.sources.scratch import settle

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
FAN = 64
SEED = 5
_NEAR = 1e-9


def words(text: Column) -> Column:
    """Runs of characters other than 0x20 and 0x09-0x0D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size -> source, source_size, target, rate.

    Sources in the order of their code points, null last, weigh ``weights`` in
    turn and divide ``share`` times all sizes by weight. A target stops at
    ``most`` times its source's size; what is over goes to the others by weight,
    until none is above. Without any words every target is 0.
    """
    ordered = numbered(sizes, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ordered = settle(
        ordered.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("limit")), "sources"
    )
    to_share = share * (ordered.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        above = F.col("weight") * level >= F.col("limit")
        at_limit, open_weight, now_full = ordered.agg(
            F.sum(F.when(above, F.col("limit")).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
            F.count(F.when(above, 1)),
        ).first()
        if now_full == full or not open_weight:
            break
        level, full = (to_share - at_limit) / open_weight, now_full
    target = F.least(F.col("weight") * level, F.col("limit"))
    rate = F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    return ordered.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def _chance(a: Column, b: Column) -> Column:
    """A number in [0, 1) that the two units fix."""
    return F.pmod(F.xxhash64(a, b, F.lit(SEED)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _meet(state: Column, unit: Column) -> Column:
    """One meeting: state (unit, p, taken) and the next unit (unit, p)."""
    held, p, q = state["unit"], state["p"], unit["p"]
    both, chance = p + q, _chance(state["unit"], unit["unit"])
    # Below 1 one of the two keeps all; else one is taken and the other keeps the rest.
    first_stays = F.when(both < 1, chance < p / both).otherwise(chance >= (1 - q) / (2 - both))
    goes_on = F.when(first_stays, held).otherwise(unit["unit"])
    taken = F.when(first_stays, unit["unit"]).otherwise(held)
    rest = F.when(both < 1, both).otherwise(both - 1)
    done = F.when(both < 1, state["taken"]).otherwise(F.concat(state["taken"], F.array(taken)))
    met = F.struct(goes_on.alias("unit"), rest.alias("p"), done.alias("taken"))
    fresh = F.struct(unit["unit"].alias("unit"), q.alias("p"), state["taken"].alias("taken"))
    return F.when(q < _NEAR, state).when(p < _NEAR, fresh).otherwise(met)


def _settled_fraction(state: Column) -> Column:
    """A rest that differs from 1 by rounding errors only is 1."""
    one = F.struct(
        state["unit"].alias("unit"), F.lit(0.0).alias("p"), F.concat(state["taken"], F.array(state["unit"])).alias("taken")
    )
    return F.when(state["p"] > 1 - _NEAR, one).otherwise(state)


def dependent_rounding(units: DataFrame) -> DataFrame:
    """source, unit (0, 1, ...; unique), p -> the units rounded up to 1, as rows of ``unit``."""
    total = units.agg(F.max("unit")).first()[0]
    current, taken, span = units.select("source", "unit", "p"), [], 1
    while total is not None:
        span *= FAN
        zero = F.struct(F.lit(-1).cast("long").alias("unit"), F.lit(0.0).alias("p"), F.array().cast("array<long>").alias("taken"))
        groups = settle(
            current.groupBy("source", F.floor(F.col("unit") / F.lit(span)).alias("node"))
            .agg(F.array_sort(F.collect_list(F.struct("unit", "p"))).alias("units"))
            .select("source", F.aggregate("units", zero, lambda s, u: _settled_fraction(_meet(s, u))).alias("end")),
            "meetings",
        )
        taken.append(groups.select(F.explode("end.taken").alias("unit")))
        current = groups.where(F.col("end.p") >= _NEAR).select("source", "end.unit", "end.p")
        if span > total:
            break
    if not taken:
        return units.select("unit").limit(0)
    alone = current.where(_chance(F.col("unit"), F.lit(-1).cast("long")) < F.col("p")).select("unit")
    for more in taken:
        alone = alone.unionByName(more)
    return alone


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """One row per row of ``docs``: how many copies of it the mix takes.

    Result: doc_id, source, text_hash (xxhash64 of the text), size (words of the
    whole text; null text: 0), source_size, target (of its source), copies and
    taken (copies times size). Null is a source of its own, the last one.
    Documents without words take part like others and add nothing. No copies
    exceed ``most`` rounded up. The order in which documents meet is that of
    source, size, a hash of the id, the id and the text's hash, so reruns agree;
    rows alike in all of that are interchangeable. An empty table gives no rows;
    other columns are not read.
    """
    sized = settle(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(text).alias("text_hash"), words(F.col(text)).alias("size")
        ),
        "sized",
    )
    shares = settle(
        targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "targets"
    ).withColumnRenamed("source", "of")
    rows = numbered(
        sized, [F.col("source").asc_nulls_last(), F.col("size"), F.xxhash64("doc_id", F.lit(SEED)), F.col("doc_id"), F.col("text_hash")], "unit"
    ).join(shares, F.col("source").eqNullSafe(F.col("of")))
    rows = settle(
        rows.select(
            "doc_id", "source", "text_hash", "size", "source_size", "target", "unit",
            F.floor("rate").alias("whole"), (F.col("rate") - F.floor("rate")).alias("p"),
        ),
        "units",
    )
    up = settle(dependent_rounding(rows).select(F.col("unit").alias("up")), "taken")
    copies = F.col("whole") + F.when(F.col("up").isNotNull(), 1).otherwise(0)
    return rows.join(up, F.col("unit") == F.col("up"), "left").select(
        "doc_id", "source", "text_hash", "size", "source_size", "target",
        copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
    )
