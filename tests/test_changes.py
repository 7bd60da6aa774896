"""Change events: last one wins, splits do not matter, history."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.operators import cdc
from shopgrain.sources import changes, layers
from shopgrain.streaming.cdc_stream import cdc_stream_merge, read_quarantine

ROW = T.StructType().add("id", "integer").add("v", "string")
SCHEMA = "id int, v string, __kind string, __ts timestamp"
START = datetime(2024, 1, 1)


def at(n):
    return START + timedelta(seconds=n)


def state(df):
    return sorted(tuple(r) for r in df.select("id", "v", "__cdc_deleted", "__cdc_op").collect())


def test_split_takes_the_right_image(spark):
    events = spark.createDataFrame(
        [
            (("c", None, (1, "a"), 1000),),
            (("r", None, (2, "b"), 1000),),
            (("u", (1, "a"), (1, "c"), 2000),),
            (("d", (2, "b"), None, 3000),),
            (("x", (2, "b"), None, 3000),),
        ],
        changes.envelope(ROW),
    )
    got = sorted((r.id, r.v, r["__kind"]) for r in cdc.cdc_split(events).collect())
    assert got == [(1, "a", "c"), (1, "c", "u"), (2, "b", "d"), (2, "b", "r")]
    assert tuple(cdc.cdc_counts(cdc.cdc_split(events)).first()) == (2, 1, 1)


def test_last_change_of_a_key_counts(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (3, "old")], ROW)
    batch = spark.createDataFrame(
        [
            (1, "late", "u", at(5)),
            (1, "early", "u", at(1)),
            (2, "gone", "d", at(2)),
            (4, "new", "c", at(1)),
            (4, "newer", "u", at(2)),
            (4, "newer", "d", at(3)),
            (5, "unknown", "u", at(1)),
            (6, "unknown", "d", at(1)),
        ],
        SCHEMA,
    )
    assert state(cdc.cdc_merge(target, batch, "id")) == [
        (1, "late", False, "UPDATE"),
        (2, "old", True, "DELETE"),
        (3, "old", None, None),
        (4, "newer", True, "DELETE"),
        (5, "unknown", False, "UPDATE"),
        (6, "unknown", True, "DELETE"),
    ]


def test_insert_after_delete_clears_the_mark(spark):
    target = spark.createDataFrame([(1, "a")], ROW)
    gone = cdc.cdc_merge(target, spark.createDataFrame([(1, "a", "d", at(1))], SCHEMA), "id")
    back = cdc.cdc_merge(gone, spark.createDataFrame([(1, "b", "c", at(2))], SCHEMA), "id")
    assert state(back) == [(1, "b", False, "INSERT")]


def test_old_event_is_ignored(spark):
    target = spark.createDataFrame([(1, "a")], ROW)
    new = cdc.cdc_merge(target, spark.createDataFrame([(1, "b", "u", at(9))], SCHEMA), "id")
    late = cdc.cdc_merge(new, spark.createDataFrame([(1, "c", "u", at(3))], SCHEMA), "id")
    assert state(late) == [(1, "b", False, "UPDATE")]


def test_empty_batch(spark):
    target = spark.createDataFrame([(1, "a")], ROW)
    assert state(cdc.cdc_merge(target, spark.createDataFrame([], SCHEMA), "id")) == [(1, "a", None, None)]


@pytest.mark.parametrize("seed", range(2))
def test_any_split_gives_the_same_table(spark, seed):
    rng = random.Random(seed)
    events = [
        (rng.randrange(12), f"v{n}", rng.choice("cuud"), at(n)) for n in range(60)
    ]
    # A delete carries the row's last values, as sources deliver them.
    last = {}
    for i, (key, value, kind, ts) in enumerate(events):
        if kind == "d":
            events[i] = (key, last.get(key, f"t{key}"), kind, ts)
        last[key] = events[i][1]
    target = spark.createDataFrame([(k, f"t{k}") for k in range(6)], ROW)
    whole = cdc.cdc_merge(target, spark.createDataFrame(events, SCHEMA), "id")
    cuts = sorted(rng.sample(range(1, 60), 3))
    split = target
    for a, b in zip([0, *cuts], [*cuts, 60]):
        split = cdc.cdc_merge(split, spark.createDataFrame(events[a:b], SCHEMA), "id")
    assert state(split) == state(whole)


@pytest.mark.parametrize("seed", range(3))
def test_late_events_give_the_same_table(spark, seed):
    """Times do not follow the order of the batches; all times differ."""
    rng = random.Random(seed)
    times = rng.sample(range(1000), 60)
    events = [(key := rng.randrange(10), f"v{n}", rng.choice("cuud"), at(t)) for n, t in enumerate(times)]
    # The image a delete carries never counts where the row has values of its own.
    events = [(k, f"t{k}" if kind == "d" else v, kind, ts) for k, v, kind, ts in events]
    target = spark.createDataFrame([(k, f"t{k}") for k in range(6)], ROW)
    whole = cdc.cdc_merge(target, spark.createDataFrame(events, SCHEMA), "id")
    cuts = sorted(rng.sample(range(1, 60), 3))
    split = target
    for a, b in zip([0, *cuts], [*cuts, 60]):
        split = cdc.cdc_merge(split, spark.createDataFrame(events[a:b], SCHEMA), "id")
    assert state(split) == state(whole)


def test_stale_update_beside_a_newer_delete(spark):
    target = spark.createDataFrame([(1, "a")], ROW)
    new = cdc.cdc_merge(target, spark.createDataFrame([(1, "t100", "u", at(100))], SCHEMA), "id")
    batch = [(1, "t50", "u", at(50)), (1, "t50", "d", at(150))]
    assert state(cdc.cdc_merge(new, spark.createDataFrame(batch, SCHEMA), "id")) == [(1, "t100", True, "DELETE")]
    gone = cdc.cdc_merge(target, spark.createDataFrame([(1, "a", "d", at(150))], SCHEMA), "id")
    late = cdc.cdc_merge(gone, spark.createDataFrame([(1, "t100", "u", at(100))], SCHEMA), "id")
    assert state(late) == [(1, "t100", True, "DELETE")]


def files(table):
    return {f.relative_to(table): f.stat().st_mtime_ns for f in table.glob("rows/*/*.parquet")}


def test_stream_leaves_untouched_buckets_alone(spark, tmp_path):
    path, table = str(tmp_path / "events"), tmp_path / "table"
    start = cdc.with_marks(spark.createDataFrame([(n, f"t{n}") for n in range(200)], ROW))
    layers.write_bucketed(start, str(table), "id", 16)
    before = files(table)
    events = spark.createDataFrame([(("u", None, (7, "new"), 1000),)], changes.envelope(ROW))
    events.coalesce(1).write.json(path)
    cdc_stream_merge(spark, path, str(table), ROW, "id", str(tmp_path / "checkpoint")).awaitTermination()
    after = files(table)
    folders = lambda names: {n.parent for n in names}
    assert folders(before) == folders(after) and len(folders(before)) == 16
    assert len(folders(set(before) ^ set(after))) == 1
    assert all(before[f] == after[f] for f in set(before) & set(after))
    rows = {r.id: r.v for r in layers.read_bucketed(spark, str(table)).collect()}
    assert rows == {n: "new" if n == 7 else f"t{n}" for n in range(200)}


def test_exchange_of_buckets_that_broke_off_is_done_again(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "table")
    layers.write_bucketed(spark.createDataFrame([(n, "old") for n in range(50)], ROW), table, "id", 4)
    with monkeypatch.context() as m:
        m.setattr(layers, "finish_replacing", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            layers.replace_buckets(spark.createDataFrame([(n, "new") for n in range(50)], ROW), table)
    # As if the driver had died between deleting a folder and moving the new one there.
    gone = next((tmp_path / "table" / "rows").glob("__bucket=*"))
    for f in gone.glob("*"):
        f.unlink()
    for f in gone.glob(".*"):
        f.unlink()
    layers.finish_replacing(spark, table)
    layers.finish_replacing(spark, table)  # nothing is left to do
    assert {r.id: r.v for r in layers.read_bucketed(spark, table).collect()} == {n: "new" for n in range(50)}
    with pytest.raises(FileExistsError):
        layers.write_bucketed(spark.createDataFrame([], ROW), table, "id", 4)


def test_large_bucket_is_split_and_small_ones_are_one_file(spark, tmp_path):
    table = tmp_path / "table"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200kb")
    try:
        # Two thirds of the rows share one key, hence one bucket.
        wide = F.concat_ws("-", *[F.sha2(F.concat("id", F.lit(n)).cast("string"), 256) for n in range(4)])
        rows = spark.range(9000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).cast("int").alias("id"), wide.alias("v"))
        layers.write_bucketed(rows, str(table), "id", 4)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    counts = {}
    for f in files(table):
        counts[f.parent] = counts.get(f.parent, 0) + 1
    assert len(counts) == 4 and max(counts.values()) > 2
    assert layers.read_bucketed(spark, str(table)).count() == 9000
    assert layers.read_bucketed(spark, str(table), [0, 1]).count() < 9000


def test_lines_that_are_no_events_are_kept(spark, tmp_path):
    lines = [
        '{"payload":{"op":"c","after":{"id":1,"v":"a"},"ts_ms":1000}}',
        '{"payload":{"op":"c","after":{"id":2,"v":',
        '{"payload":{"op":"z","after":{"id":3,"v":"a"},"ts_ms":1000}}',
        '{"payload":{"op":"u","after":{"id":"x","v":"a"},"ts_ms":1000}}',
        '{"payload":{"op":"u","after":{"v":"a"},"ts_ms":1000}}',
        '{"payload":{"op":"u","after":{"id":4,"v":"a"}}}',
        '{"payload":{"op":"d","after":{"id":4,"v":"a"},"ts_ms":1000}}',
        "[]",
        '{"x":1}',
        "",
        "not json",
    ]
    path, table = tmp_path / "events", str(tmp_path / "table")
    path.mkdir()
    (path / "part.json").write_text("\n".join(lines))
    reasons = {r.line: r.reason for r in changes.read_judged(spark, str(path), ROW, "id").collect()}
    assert [reasons.get(x) for x in lines] == [
        None, "malformed", "unknown op", "malformed", "no key", "no time", "no row", reasons["[]"], "no envelope", None, "malformed"
    ]
    assert reasons["[]"] in ("malformed", "no envelope") and len(reasons) == 10
    for _ in range(2):
        cdc_stream_merge(spark, str(path), table, ROW, "id", str(tmp_path / "checkpoint")).awaitTermination()
    assert [r.id for r in layers.read_bucketed(spark, table).collect()] == [1]
    kept = read_quarantine(spark, table).collect()
    assert {r.line: r.reason for r in kept} == {k: v for k, v in reasons.items() if v} and len(kept) == 9


def test_loads_since_a_mark_lose_and_repeat_nothing(spark, tmp_path):
    path, kind = str(tmp_path / "table"), "id int, v string, updated_at timestamp"

    def load(rows):
        got = cdc.load_since_mark(spark.createDataFrame(rows, kind), path, "id")
        return sorted((r.id, r.v) for r in got.collect())

    first = [(1, "a", at(1)), (2, "b", at(5)), (3, "c", at(5)), (None, "x", at(9)), (4, "no time", None)]
    assert load(first) == [(1, "a"), (2, "b"), (3, "c")]
    tied = [*first, (5, "late, on the mark", at(5)), (1, "old news", at(4)), (6, "new", at(6)), (6, "newer", at(7))]
    want = [(1, "a"), (2, "b"), (3, "c"), (5, "late, on the mark"), (6, "newer")]
    assert load(tied) == want and load(tied) == want and load([]) == want
    assert load([(6, "newer still", at(7))])[-1] == (6, "newer still") and load(tied)[-1] == (6, "newer")
    layers.point_to(spark, f"{path}/_mark", str(at(1)))  # as if the last load had ended before its mark was stored
    assert load([*tied, (1, "now", at(8))]) == [(1, "now"), *want[1:]]


def test_soft_delete_of_unknown_key_adds_nothing(spark):
    target = spark.createDataFrame([(1, "a")], ROW)
    batch = spark.createDataFrame([(2, "x", "d", at(1))], SCHEMA)
    assert state(cdc.cdc_soft_delete(target, batch, "id")) == [(1, "a", None, None)]


def test_replication_records(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], ROW)
    records = spark.createDataFrame(
        [(1, "z", "U", at(1)), (2, "b", "D", at(1)), (3, "c", "I", at(1))],
        "id int, v string, Op string, __dms_timestamp timestamp",
    )
    assert state(cdc.cdc_apply_op(target, records, "id")) == [
        (1, "z", False, "UPDATE"),
        (2, "b", True, "DELETE"),
        (3, "c", False, "INSERT"),
    ]


def test_stream_equals_batch(spark, tmp_path):
    events = spark.createDataFrame(
        [(("c" if n < 5 else "u", None, (n % 5, f"v{n}"), 1000 * n),) for n in range(20)],
        changes.envelope(ROW),
    )
    # Files arrive in order of time, one per micro-batch.
    path = str(tmp_path / "events")
    for start in range(0, 20, 5):
        part = events.where(f"payload.ts_ms >= {start * 1000} AND payload.ts_ms < {(start + 5) * 1000}")
        part.coalesce(1).write.mode("append").json(path)
    table = str(tmp_path / "table")
    for _ in range(2):  # the second run finds nothing new
        cdc_stream_merge(
            spark, path, table, ROW, "id", str(tmp_path / "checkpoint"), files_per_batch=1
        ).awaitTermination()
    batch = cdc.cdc_merge(spark.createDataFrame([], ROW), cdc.cdc_split(events), "id")
    assert state(layers.read_bucketed(spark, table)) == state(batch)


def history(spark):
    return spark.createDataFrame(
        [(1, date(2024, 1, d), s) for d, s in [(1, "a"), (2, "a"), (3, "b"), (5, None), (6, None), (7, "a")]]
        + [(2, date(2024, 1, 4), "x")],
        "k int, since date, s string",
    )


def test_scd2(spark):
    got = sorted(tuple(r) for r in cdc.scd2(history(spark), "k", "since", ["s"]).collect())
    d = lambda n: date(2024, 1, n)
    assert got == [
        (1, d(1), "a", d(3), False),
        (1, d(3), "b", d(5), False),
        (1, d(5), None, d(7), False),
        (1, d(7), "a", None, True),
        (2, d(4), "x", None, True),
    ]


def test_scd2_merge(spark):
    dimension = cdc.scd2(history(spark), "k", "since", ["s"])
    snapshot = spark.createDataFrame([(1, "z"), (3, "new")], "k int, s string")
    got = cdc.scd2_merge(dimension, snapshot, "k", ["s"], "2024-02-01")
    current = sorted((r.k, r.s, str(r.effective_from)) for r in got.where("is_current").collect())
    assert current == [(1, "z", "2024-02-01"), (2, "x", "2024-01-04"), (3, "new", "2024-02-01")]
    closed = got.where("k = 1 AND effective_to = DATE'2024-02-01'").first()
    assert (closed.s, closed.is_current) == ("a", False)
    again = cdc.scd2_merge(got, snapshot, "k", ["s"], "2024-03-01")
    assert sorted(map(repr, again.collect())) == sorted(map(repr, got.select(*again.columns).collect()))
