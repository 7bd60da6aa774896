"""Change events applied to a table: inserts, updates, soft deletes, history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.operators.global_order import GlobalOrder
from shopgrain.operators.silver import keep_one
from shopgrain.sources.changes import OP, STAMP
from shopgrain.sources.layers import current_version, point_to, read_version, write_version
from shopgrain.sources.scratch import settle

DELETED, LAST_OP, LAST_TS = "__cdc_deleted", "__cdc_op", "__cdc_ts"
#: When the row's values were last set; a later delete leaves it as it is.
VALUE_TS = "__cdc_value_ts"
KIND, TS, VALUED = "__kind", "__ts", "__valued"
_NAMES = {"c": "INSERT", "r": "INSERT", "u": "UPDATE", "d": "DELETE"}
_FROM_OP = {"I": "c", "U": "u", "D": "d"}


def cdc_split(events: DataFrame) -> DataFrame:
    """Envelopes as rows with ``__kind`` and ``__ts``: the new row, of deletes the old one."""
    op = F.col("payload.op")
    row = F.when(op == "d", F.col("payload.before")).otherwise(F.col("payload.after"))
    return (
        events.where(op.isin(*_NAMES))
        .select(row.alias("__row"), op.alias(KIND), F.timestamp_millis("payload.ts_ms").alias(TS))
        .select("__row.*", KIND, TS)
    )


def from_op_records(records: DataFrame) -> DataFrame:
    """Replication records in the form ``cdc_split`` gives."""
    kinds = F.create_map(*[F.lit(x) for pair in _FROM_OP.items() for x in pair])
    return records.withColumn(KIND, kinds[F.col(OP)]).withColumn(TS, F.col(STAMP)).drop(OP, STAMP)


def latest(changes: DataFrame, key: str) -> DataFrame:
    """One row per key: the last values, whether a delete came after them, and when.

    ``__kind`` is ``d`` when the last change is a delete; ``__valued`` tells
    whether an insert or update is among the changes, and ``__cdc_value_ts`` when
    the last of them was. An aggregate, so a key with a
    third of all events is reduced inside the map tasks.
    """
    columns = [c for c in changes.columns if c not in (KIND, TS)]
    kind, row = F.col(KIND), F.struct(*columns)
    rank = F.when(kind == "u", 1).otherwise(0)
    up = F.max(F.when(kind != "d", F.struct(F.col(TS), rank.alias("rank"), kind, row.alias("row"))))
    down = F.max(F.when(kind == "d", F.struct(F.col(TS), row.alias("row"))))
    reduced = changes.dropna(subset=[key]).groupBy(F.col(key).alias("__key")).agg(
        up.alias("up"), down.alias("down")
    )
    gone = F.coalesce(F.col(f"down.{TS}") >= F.col(f"up.{TS}"), F.col("up").isNull())
    return reduced.select(
        F.coalesce("up.row", "down.row").alias("row"),
        F.when(gone, F.lit("d")).otherwise(F.col(f"up.{KIND}")).alias(KIND),
        F.greatest(f"up.{TS}", f"down.{TS}").alias(TS),
        F.col("up").isNotNull().alias(VALUED),
        F.col(f"up.{TS}").alias(VALUE_TS),
    ).select("row.*", KIND, TS, VALUED, VALUE_TS)


def with_marks(table: DataFrame) -> DataFrame:
    """The table with the change columns, empty where it has none yet."""
    kinds = {DELETED: "boolean", LAST_OP: "string", LAST_TS: "timestamp", VALUE_TS: "timestamp"}
    missing = {c: F.lit(None).cast(t) for c, t in kinds.items() if c not in table.columns}
    return table.withColumns(missing) if missing else table


def _marks(kind: Column, ts: Column) -> list[Column]:
    names = F.create_map(*[F.lit(x) for pair in _NAMES.items() for x in pair])
    return [(kind == "d").alias(DELETED), names[kind].alias(LAST_OP), ts.alias(LAST_TS)]


def cdc_merge(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The table after the changes.

    Per key the last values are taken if they are not older than the values the row
    has, whatever deletes came meanwhile; the marks follow the last change of all,
    a delete before an update of the same time. So events may repeat and come late,
    and a stream split into batches gives the table one batch gives.
    Deletes mark the row and keep its values. A delete that comes before its row
    leaves a marked row, which a late insert does not revive.

    The changes are reduced to one row per key and settled, which makes their size
    known: when it allows a broadcast, the table is streamed past them unshuffled.
    """
    table = with_marks(target)
    columns = [c for c in table.columns if c not in (DELETED, LAST_OP, LAST_TS, VALUE_TS)]
    last = settle(latest(changes, key), "changes")
    new = last.select(
        F.col(key).alias("__key"), *[F.col(c).alias(f"__new_{c}") for c in columns], KIND, TS, VALUED,
        F.col(VALUE_TS).alias("__new_value_ts"),
    )
    kind, ts = F.col(KIND), F.col(TS)
    undone = (ts == F.col(LAST_TS)) & (F.col(LAST_OP) == "DELETE") & (kind != "d")
    newer = kind.isNotNull() & (F.col(LAST_TS).isNull() | ((ts >= F.col(LAST_TS)) & ~undone))
    valued_at = F.coalesce(VALUE_TS, F.when(F.col(LAST_OP) != "DELETE", F.col(LAST_TS)))
    revalued = F.col(VALUED) & (valued_at.isNull() | (F.col("__new_value_ts") >= valued_at))
    kept = table.join(new, F.col(key) == F.col("__key"), "left").select(
        *[F.when(revalued, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) for c in columns],
        *[
            F.when(newer, mark).otherwise(F.col(name)).alias(name)
            for mark, name in zip(_marks(kind, ts), (DELETED, LAST_OP, LAST_TS))
        ],
        F.when(revalued, F.col("__new_value_ts")).otherwise(valued_at).alias(VALUE_TS),
    )
    known = table.select(key).join(last.select(key), key, "left_semi")
    added = last.join(known, key, "left_anti").select(*columns, *_marks(kind, ts), VALUE_TS)
    return kept.unionByName(added)


def cdc_upsert(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Inserts and updates only."""
    return cdc_merge(target, changes.where(F.col(KIND) != "d"), key)


def cdc_soft_delete(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Deletes only, of rows the table has."""
    gone = changes.where(F.col(KIND) == "d").join(target.select(key), key, "left_semi")
    return cdc_merge(target, gone, key)


def cdc_apply_op(target: DataFrame, records: DataFrame, key: str) -> DataFrame:
    return cdc_merge(target, from_op_records(records), key)


def cdc_counts(changes: DataFrame) -> DataFrame:
    """One row: inserts, updates, deletes."""
    kind = F.col(KIND)
    return changes.agg(
        F.count_if(kind.isin("c", "r")).alias("inserts"),
        F.count_if(kind == "u").alias("updates"),
        F.count_if(kind == "d").alias("deletes"),
    )


def incremental_by_updated_at(
    source: DataFrame, mark: str, column: str = "updated_at"
) -> DataFrame:
    """Rows changed after the high-water mark; the filter runs inside the source."""
    return source.where(F.col(column) > F.lit(mark).cast("timestamp"))


def load_since_mark(source: DataFrame, path: str, key: str, column: str = "updated_at") -> DataFrame:
    """The table at ``path`` with the rows of ``source`` that changed since its last load.

    The mark is the greatest ``column`` loaded so far. It is stored beside the table
    and moves only after the table is written, and rows on the mark are read again:
    a load that failed, or rows that got the mark's very time after it was taken, are
    made up for by the next one. Of a key the latest row stays, so nothing repeats.
    Rows without a key or a time are left out. One load at a time.
    """
    spark, marks = source.sparkSession, f"{path}/_mark"
    mark, table = current_version(spark, marks), current_version(spark, path)
    fresh = source.dropna(subset=[key, column])
    if mark is not None:
        fresh = fresh.where(F.col(column) >= F.lit(mark).cast(source.schema[column].dataType))
    fresh = settle(keep_one(fresh, [key], F.col(column), latest=True), "fresh")
    newest = fresh.agg(F.max(column).cast("string")).first()[0]
    if newest is None:
        return read_version(spark, path) if table is not None else fresh
    if table is not None:
        old = read_version(spark, path)
        # A source may bring an older row on the mark; of rows of one time the one read last stays.
        times = fresh.select(F.col(key).alias("__key"), F.col(column).alias("__at"))
        newer = old.join(times, (F.col(key) == F.col("__key")) & (F.col(column) > F.col("__at")), "left_semi")
        fresh = (
            old.join(fresh.select(key), key, "left_anti")
            .unionByName(newer)
            .unionByName(fresh.join(newer.select(key), key, "left_anti"))
        )
    write_version(fresh, path)
    point_to(spark, marks, newest)
    return read_version(spark, path)


# -- history -----------------------------------------------------------------


def scd2(history: DataFrame, key: str, since: str, tracked: Sequence[str]) -> DataFrame:
    """Versions of each key: one per change of the tracked columns.

    ``history`` has one row per key and ``since``. A key may hold any share of
    the rows: neighbours are found in one global order, not in a window per key.
    """
    state = F.struct(*tracked)
    rows = history.select(key, since, *tracked, state.alias("__state"))
    backwards = rows.withColumn("__order", -F.unix_micros(F.col(since).cast("timestamp")))
    changed = (
        GlobalOrder(backwards)
        .next_in_group([key], ["__order"], "__state", "__before")
        .df.where(~F.col("__state").eqNullSafe(F.col("__before")))
        .select(key, since, *tracked)
    )
    versions = GlobalOrder(changed).next_in_group([key], [since], since, "effective_to").df
    return versions.withColumnRenamed(since, "effective_from").withColumn(
        "is_current", F.col("effective_to").isNull()
    )


def scd2_merge(
    dimension: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], as_of: str
) -> DataFrame:
    """A dimension after today's snapshot: changed rows are closed, new versions opened."""
    today, names = F.lit(as_of).cast("date"), dimension.columns
    state = F.struct(*tracked)
    # Only open versions meet the snapshot; one join then gives each key's rows.
    fresh = snapshot.select(F.col(key).alias("__key"), state.alias("__new"))
    compared = dimension.withColumn("__old", state).join(
        fresh, F.col("is_current") & (F.col(key) == F.col("__key")), "full_outer"
    )
    known, met = F.col("is_current").isNotNull(), F.col("__new").isNotNull()
    changed = met & ~F.col("__old").eqNullSafe(F.col("__new"))

    def version(values: dict[str, Column]) -> Column:
        return F.struct(*[values.get(c, F.col(c)).alias(c) for c in names])

    kept = version({})
    ended = version({"effective_to": today, "is_current": F.lit(False)})
    opened = version(
        {
            key: F.col("__key"),
            "effective_from": today,
            "effective_to": F.lit(None).cast(dimension.schema["effective_to"].dataType),
            "is_current": F.lit(True),
            **{c: F.col(f"__new.{c}") for c in tracked},
        }
    )
    rows = F.array(
        F.when(known, F.when(changed, ended).otherwise(kept)), F.when(met & (changed | ~known), opened)
    )
    return compared.select(F.explode(F.array_compact(rows)).alias("row")).select("row.*")
