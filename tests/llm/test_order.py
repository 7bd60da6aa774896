"""Row numbers over a whole table, and the sieve before a join."""

from pyspark.sql import functions as F

from shopgrain.llm.order import numbered
from shopgrain.llm.sieve import sieved


def test_numbers_and_sums_before(spark):
    rows = spark.range(500).select((F.col("id") * 7919 % 500).alias("v"), (F.col("id") % 9).alias("w")).repartition(5)
    got = sorted((r.n, r.v, r.w, r.w_before) for r in numbered(rows, [F.col("v")], "n", total="w").collect())
    before = 0
    for place, (n, v, w, w_before) in enumerate(got):
        assert (n, v, w_before) == (place, place, before)
        before += w
    assert numbered(rows.limit(0), [F.col("v")], "n").collect() == []


def test_no_row_with_a_key_is_lost(spark):
    keys = spark.createDataFrame([(3,), (3,), (None,), (10**12,)], "k long")
    rows = spark.range(5000).select(F.col("id").alias("k")).unionByName(keys)
    got = [r.k for r in sieved(rows, keys, "k").collect()]
    assert sorted(k for k in got if k is not None)[-1] == 10**12 and got.count(3) == 3 and None in got
    assert len(got) < 50
