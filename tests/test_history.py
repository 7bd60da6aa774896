"""History from snapshots: any order gives the history of the sorted ones."""

import random
from datetime import date, timedelta

import pytest

from shopgrain.operators import history

KIND = "k int, s string, n int"


def day(n):
    return str(date(2024, 1, 1) + timedelta(days=n))


def expected(snapshots):
    """Versions of the snapshots in order of their days, key by key."""
    out, days = [], sorted(snapshots)
    for key in {k for rows in snapshots.values() for k in rows}:
        opened = None
        for at in [*days, None]:
            now = snapshots[at].get(key) if at is not None else None
            if opened and (at is None or now != opened[1]):
                out.append((key, day(opened[0]), *opened[1], None if at is None else day(at), at is None))
                opened = None
            if now is not None and opened is None:
                opened = (at, now)
    return sorted(out, key=repr)


def load(spark, path, at, rows):
    df = spark.createDataFrame([(k, *v) for k, v in rows.items()], KIND)
    got = history.load_snapshot(df, path, "k", ["s", "n"], day(at))
    columns = [r.asDict() for r in got.collect()]
    return sorted(
        (
            (r["k"], str(r["effective_from"]), r["s"], r["n"], r["effective_to"] and str(r["effective_to"]), r["is_current"])
            for r in columns
        ),
        key=repr,
    )


@pytest.mark.parametrize("seed", range(3))
def test_any_order_gives_the_same_history(spark, tmp_path, seed):
    rng = random.Random(seed)
    days = rng.sample(range(30), 6)
    snapshots = {
        d: {k: (rng.choice(["a", None]), rng.choice([1, None])) for k in range(25) if rng.random() < 0.7} for d in days
    }
    seen = {}
    for at in days:  # in no order
        seen[at] = snapshots[at]
        got = load(spark, str(tmp_path / "t"), at, snapshots[at])
    assert got == expected(seen)
    again = rng.choice(days)
    assert load(spark, str(tmp_path / "t"), again, snapshots[again]) == got
    seen[again] = {k: ("corrected", k) for k in range(0, 25, 2)}
    assert load(spark, str(tmp_path / "t"), again, seen[again]) == expected(seen)


def test_late_snapshot_splits_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, path, 1, {1: ("a", 1)})
    assert load(spark, path, 9, {1: ("a", 1)}) == [(1, day(1), "a", 1, None, True)]
    assert load(spark, path, 5, {1: ("b", 1)}) == [
        (1, day(1), "a", 1, day(5), False), (1, day(5), "b", 1, day(9), False), (1, day(9), "a", 1, None, True)
    ]


def test_failed_load_is_made_up_for(spark, tmp_path, monkeypatch):
    path, snapshots = str(tmp_path / "t"), {1: {1: ("a", 1)}, 9: {1: ("a", 1), 2: ("x", 2)}, 5: {1: ("b", 1)}}
    load(spark, path, 1, snapshots[1])
    with monkeypatch.context() as m:
        m.setattr(history, "write_version", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(spark, path, 9, snapshots[9])
    load(spark, path, 5, snapshots[5])
    assert load(spark, path, 9, snapshots[9]) == expected(snapshots)


def test_empty_snapshot_ends_all_and_nulls_are_left_out(spark, tmp_path):
    path = str(tmp_path / "t")
    assert load(spark, path, 1, {1: ("a", 1), None: ("x", 1)}) == [(1, day(1), "a", 1, None, True)]
    assert load(spark, path, 3, {}) == [(1, day(1), "a", 1, day(3), False)]
    assert load(spark, path, 2, {}) == [(1, day(1), "a", 1, day(2), False)]
