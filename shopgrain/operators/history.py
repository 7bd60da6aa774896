"""Version history of a table known from whole snapshots, in whatever order they come."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.operators.silver import keep_one
from shopgrain.sources.layers import current_version, point_to, read_version, write_version

FROM, TO, CURRENT = "effective_from", "effective_to", "is_current"


def apply_snapshot(
    versions: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], day: str, until: str | None
) -> DataFrame:
    """The versions after the snapshot of ``day``, which holds all rows of that day.

    ``until`` is the day of the next later snapshot taken so far, None if there is none:
    what the snapshot says holds from ``day`` up to it, and nothing is changed
    outside. The version that covers ``day`` is split; a key that the snapshot lacks
    has no version between; neighbours of equal values become one. The same day may
    be given again, with the same rows or corrected ones.

    Only versions that meet [day, until] are shuffled, at most three of a key, since versions
    begin and end on days of snapshots only. Rows of the snapshot without a key are
    left out, of several rows of a key one stays.
    """
    start, end = F.lit(day).cast("date"), F.lit(until).cast("date")
    state = F.struct(*tracked)
    meets = (F.col(TO).isNull() | (F.col(TO) >= start)) & F.coalesce(F.col(FROM) <= end, F.lit(True))
    far = versions.where(~meets)

    def near(which: Column) -> Column:
        row = F.struct(F.col(FROM).alias("f"), F.col(TO).alias("t"), state.alias("s"))
        return F.max(F.when(which, row))

    open_on = (F.col(FROM) < end) if until else F.lit(True)
    around = (
        versions.where(meets)
        .groupBy(F.col(key).alias("__key"))
        .agg(
            near(F.col(TO) <= start).alias("before"),
            near((F.col(FROM) <= start) & (F.col(TO).isNull() | (F.col(TO) > start)) & open_on).alias("on"),
            near(F.col(FROM) >= end if until else F.lit(False)).alias("after"),
        )
    )
    rows = keep_one(snapshot.dropna(subset=[key]).select(key, *tracked), [key], F.lit(0))
    said = rows.select(F.col(key).alias("__said_key"), state.alias("said"))
    both = around.join(said, F.col("__key") == F.col("__said_key"), "full_outer")

    def piece(since, to, values) -> Column:
        return F.struct(since.alias("f"), to.alias("t"), values.alias("s"))

    # At most five pieces: what ended on the day, what was before it and after `until`
    # of the covering version, the snapshot's own, what begins at `until`.
    later = F.col("on.t").isNull() | (F.col("on.t") > end)
    pieces = F.array_compact(
        F.array(
            F.col("before"),
            F.when(F.col("on.f") < start, piece(F.col("on.f"), start, F.col("on.s"))),
            F.when(F.col("__said_key").isNotNull(), piece(start, end, F.col("said"))),
            F.when(F.col("on").isNotNull() & later, piece(end, F.col("on.t"), F.col("on.s"))) if until else F.lit(None),
            F.col("after"),
        )
    )

    def extend(done: Column, new: Column) -> Column:
        last = F.element_at(done, -1)
        joined = piece(last["f"], new["t"], last["s"])
        touches = (F.size(done) > 0) & last["t"].eqNullSafe(new["f"]) & last["s"].eqNullSafe(new["s"])
        return F.when(
            touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))
        ).otherwise(F.concat(done, F.array(new)))

    none = F.slice(pieces, 1, 0)
    whole = both.select(
        F.coalesce("__key", "__said_key").alias("__key"), F.explode(F.reduce(pieces, none, extend)).alias("v")
    )
    changed = whole.select(
        F.col("__key").alias(key),
        F.col("v.f").alias(FROM),
        *[F.col("v.s")[c].alias(c) for c in tracked],
        F.col("v.t").alias(TO),
        F.col("v.t").isNull().alias(CURRENT),
    )
    return far.select(*changed.columns).unionByName(changed)


def load_snapshot(
    snapshot: DataFrame, path: str, key: str, tracked: Sequence[str], day: str
) -> DataFrame:
    """The version table at ``path`` after the snapshot of ``day`` (yyyy-mm-dd).

    Beside the table lie the days of the snapshots taken, one row each. They alone are enough to place a
    late snapshot: between two of them nothing is known but what the earlier one said. The day is
    stored before the table is written. If the table's write fails, the day is a border at which nothing
    changes, until the snapshot is loaded again. One load at a time; days fill at most 64 KB (5,900 of them).
    """
    spark, days_path = snapshot.sparkSession, f"{path}/_days"
    day = str(spark.range(1).select(F.lit(day).cast("date")).first()[0])
    days = _days(spark, days_path)
    until = min((d for d in days if d > day), default=None)
    if day not in days:
        # One number per snapshot taken, whatever the table's size.
        point_to(spark, days_path, " ".join(sorted([*days, day])))
    if current_version(spark, path) is None:
        old = snapshot.limit(0).select(
            key, F.lit(None).cast("date").alias(FROM), *tracked,
            F.lit(None).cast("date").alias(TO), F.lit(True).alias(CURRENT),
        )
    else:
        old = read_version(spark, path)
    write_version(apply_snapshot(old, snapshot, key, tracked, day, until), path)
    return read_version(spark, path)


def _days(spark: SparkSession, path: str) -> list[str]:
    stored = current_version(spark, path)
    return stored.split() if stored else []
