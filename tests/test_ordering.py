"""Whole-table windows: the distributed way equals the plain window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopgrain.operators.global_order import GlobalOrder

KEY = [F.col]


def table(spark, n, seed=1):
    rng = random.Random(seed)
    # A third of the rows share one value.
    data = [(i, 5 if rng.random() < 0.34 else rng.randrange(50), rng.randrange(1, 9)) for i in range(n)]
    return spark.createDataFrame(data, "id int, v int, w int").repartition(5)


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 12, 23, 400])
def test_ntile_and_row_number(spark, n):
    df = table(spark, n)
    order = [F.col("v"), F.col("id")]
    got = GlobalOrder(df).ntile(5, order, "tile").row_number(order, "rn").df
    w = Window.orderBy(*order)
    want = df.withColumn("tile", F.ntile(5).over(w)).withColumn("rn", F.row_number().over(w).cast("long"))
    columns = ["id", "tile", "rn"]
    assert sorted(got.select(*columns).collect()) == sorted(want.select(*columns).collect())


def test_tiles_differ_by_one_at_most(spark):
    got = GlobalOrder(table(spark, 503)).ntile(5, [F.col("v"), F.col("id")], "tile").df
    sizes = [r["count"] for r in got.groupBy("tile").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_rank_and_running_sum(spark):
    df = table(spark, 400)
    got = GlobalOrder(df).rank("v", "rank", "id").running_sum("w", [F.desc("v"), F.col("id")], "run").df
    w = Window.orderBy(F.desc("v"), "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("rank", F.rank().over(Window.orderBy(F.desc("v")))).withColumn("run", F.sum("w").over(w))
    columns = ["id", "rank", "run"]
    assert sorted(got.select(*columns).collect()) == sorted(want.select(*columns).collect())


def test_rank_of_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 3), (3, None), (4, 1)], "id int, v int")
    got = {r.id: r["rank"] for r in GlobalOrder(df).rank("v", "rank", "id").df.collect()}
    assert got == {2: 1, 4: 2, 1: 3, 3: 3}


def test_next_in_group(spark):
    df = table(spark, 300)
    got = GlobalOrder(df).next_in_group(["v"], ["id"], "w", "after").df
    want = df.withColumn("after", F.lead("w").over(Window.partitionBy("v").orderBy("id")))
    columns = ["id", "after"]
    assert sorted(got.select(*columns).collect(), key=repr) == sorted(want.select(*columns).collect(), key=repr)


@pytest.mark.parametrize("block", [3, 7, 64, 100_000])
def test_frames_across_blocks(spark, block):
    rng = random.Random(block)
    # One group holds half of all rows; nulls among keys and values.
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), n, rng.choice([None, n % 11])) for n in range(300)]
    df = spark.createDataFrame(rows, "k string, n int, v int")
    back = 3

    def columns(w):
        return {
            "lag1": F.lag("v", 1).over(w),
            "lag3": F.lag("v", back).over(w),
            "total": F.sum("v").over(w.rowsBetween(-back, 0)),
        }

    got = GlobalOrder(df).frames(["k"], ["n"], back, columns, block=block).df
    plain = df.select("*", *[c.alias(n) for n, c in columns(Window.partitionBy("k").orderBy("n")).items()])
    assert got.columns == plain.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_frames_of_nothing_and_of_too_small_blocks(spark):
    empty = GlobalOrder(spark.createDataFrame([], "k int, n int"))
    assert empty.frames(["k"], ["n"], 1, lambda w: {"x": F.lag("n").over(w)}).df.count() == 0
    with pytest.raises(ValueError):
        empty.frames(["k"], ["n"], 3, lambda w: {}, block=2)
