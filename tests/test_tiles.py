"""Tiles by counting equal NTILE over a sorted table."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopgrain.operators import tiles

KIND = "id long, days int, price decimal(20,4), wide decimal(38,0), far long, day date"


def table(spark, n, seed):
    rng = random.Random(seed)
    rows = [
        (
            i * 7919 - 5000,
            # A third of the rows share one value; some have none.
            5 if rng.random() < 0.34 else rng.choice([None, rng.randrange(-40, 9)]),
            f"{rng.randrange(-10**9, 10**12)}.{rng.randrange(10**4):04}" if rng.random() < 0.9 else None,
            str(rng.randrange(-10**30, 10**30)),
            rng.choice([-(2**63), 2**63 - 1, 0, i]),
            f"20{rng.randrange(10, 30)}-0{rng.randrange(1, 9)}-11",
        )
        for i in range(n)
    ]
    text = spark.createDataFrame(rows, "id long, days int, price string, wide string, far long, day string")
    return text.selectExpr("id", "days", "CAST(price AS DECIMAL(20,4)) AS price", "CAST(wide AS DECIMAL(38,0)) AS wide", "far", "CAST(day AS DATE) AS day")


def orders():
    out = {f"{c}_{d}": [(c, d), ("id", not d)] for c in ("days", "price", "wide", "far", "day") for d in (False, True)}
    return out | {"three": [("days", True), ("day", False), ("id", True)]}


@pytest.mark.parametrize("n,k", [(1000, 5), (997, 4), (7, 5), (3, 5), (1, 2), (0, 5), (40, 1)])
def test_equal_to_ntile(spark, n, k):
    df, given = table(spark, n, n), orders()
    got = tiles.add_tiles(df, k, given)

    def plain(order):
        return F.ntile(k).over(Window.orderBy(*[F.col(c).desc() if d else F.col(c).asc() for c, d in order]))

    want = df.select("id", *[plain(order).alias(name) for name, order in given.items()])
    columns = ["id", *given]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.collect()))


def test_few_bins_take_more_passes(spark, monkeypatch):
    monkeypatch.setattr(tiles, "BINS", 3)
    df = table(spark, 200, 5).select("id", "days")
    got = tiles.add_tiles(df, 5, {"t": [("days", False), ("id", False)]})
    want = df.withColumn("t", F.ntile(5).over(Window.orderBy("days", "id")))
    assert sorted(map(tuple, got.select("id", "t").collect())) == sorted(map(tuple, want.select("id", "t").collect()))


def test_no_sort_and_no_shuffle_in_the_plan(spark):
    got = tiles.add_tiles(table(spark, 50, 1), 5, orders())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan and "Window" not in plan


def test_all_null_repeated_rows_and_other_kinds(spark):
    empty = spark.createDataFrame([(None, 1), (None, 2)], "x int, id int")
    got = tiles.add_tiles(empty, 2, {"t": [("x", True), ("id", False)], "none": [("x", False)]})
    assert sorted(map(tuple, got.select("id", "t", "none").collect())) == [(1, 1, 1), (2, 2, 1)]
    twins = spark.createDataFrame([(1,)] * 6, "x int")
    assert {r.t for r in tiles.add_tiles(twins, 3, {"t": [("x", False)]}).collect()} == {3}
    with pytest.raises(TypeError):
        tiles.add_tiles(spark.createDataFrame([(1.5,)], "x double"), 2, {"t": [("x", False)]})
