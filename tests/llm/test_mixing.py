"""Mixing: targets against a loop over sources, rounding by its guarantees."""

import pytest
from pyspark.sql import functions as F

from shopgrain.llm.mixing import dependent_rounding, mix_sources, targets, words
from tests.llm.tools import documents


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Source sizes by name -> targets, sharing the excess until nobody has any."""
    names = sorted((n for n in sizes if n is not None), key=lambda s: s.encode()) + [n for n in sizes if n is None]
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    full, left = {}, share * sum(sizes.values())
    while True:
        free = [n for n in names if n not in full]
        scale = sum(weight[n] for n in free)
        over = [n for n in free if left * weight[n] / scale > most * sizes[n]] if scale else []
        if not over:
            return {n: full.get(n, left * weight[n] / scale if n not in full else 0) for n in names}
        for n in over:
            full[n] = most * sizes[n]
            left -= full[n]


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 10, "Z": 500, None: 40},
        {"é": 5, "z": 0, "a": 7, "\U0001f600": 9, "￮": 11},
        {"only": 10},
        {f"s{i}": 2**i for i in range(20)},
    ],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r for r in targets(df).collect()}
    want = brute_targets(sizes)
    for name, target in want.items():
        assert got[name].target == pytest.approx(target, rel=1e-9)
        assert got[name].rate == pytest.approx(target / sizes[name] if sizes[name] else 0, rel=1e-9)


def test_words_are_counted_by_the_given_white_space(spark):
    df = spark.createDataFrame([("a  b\x0bc\xa0d\n",), (None,), ("",), (" ",)], "t string")
    assert [r[0] for r in df.select(words(F.col("t"))).collect()] == [3, 0, 0, 0]


def test_rounding_keeps_the_sum(spark):
    units = spark.range(5000).select(
        (F.col("id") % 3).cast("string").alias("source"), F.col("id").alias("unit"), ((F.col("id") * 37 % 100) / 100).alias("p")
    )
    units = units.orderBy("source").select("source", "unit", "p")
    up = {r.unit for r in dependent_rounding(units).collect()}
    rows = units.collect()
    for source in "012":
        own = [r for r in rows if r.source == source]
        assert abs(len([r for r in own if r.unit in up]) - sum(r.p for r in own)) < 1 + 1e-6
    assert not {r.unit for r in rows if r.p == 0} & up


def test_units_keep_their_probability(spark):
    units = spark.range(4000).select(
        F.lit("s").alias("source"), F.col("id").alias("unit"), F.when(F.col("id") % 2 == 0, 0.2).otherwise(0.7).alias("p")
    )
    up = [r.unit for r in dependent_rounding(units).collect()]
    assert len(up) == len(set(up))
    assert abs(sum(u % 2 == 0 for u in up) / 2000 - 0.2) < 0.04
    assert abs(sum(u % 2 == 1 for u in up) / 2000 - 0.7) < 0.04


def test_mix(spark):
    rows = [(n, "w " * (1 + n % 50), "en", "hot" if n % 3 == 0 else f"s{n % 7}") for n in range(3000)]
    rows += [(5000 + n, None, "en", None) for n in range(5)] + [(6000, "x y", "en", None), (6001, "", "en", "empty")]
    rows += [(7000, "again and again", "en", "s1")] * 4
    df = documents(spark, rows, clash=True)
    got = mix_sources(df).collect()
    assert len(got) == len(rows)
    by_source = {}
    for r in got:
        by_source.setdefault(r.source, []).append(r)
        assert r.copies <= 2 and r.taken == r.copies * r.size <= 2 * r.size
    sizes = {s: sum(r.size for r in rs) for s, rs in by_source.items()}
    want = brute_targets(sizes)
    for source, rs in by_source.items():
        assert all(r.source_size == sizes[source] and r.target == pytest.approx(want[source]) for r in rs)
        assert abs(sum(r.taken for r in rs) - want[source]) <= max(0.02 * want[source], 60)
    again = mix_sources(df.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_no_words_and_no_rows(spark):
    assert [(r.target, r.taken) for r in mix_sources(documents(spark, [(1, None), (2, " ")])).collect()] == [(0, 0)] * 2
    assert mix_sources(documents(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = mix_sources(documents(spark, [(1, "a b", "en", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
