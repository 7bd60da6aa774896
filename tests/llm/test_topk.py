"""Inner products against brute force."""

import numpy as np
import pytest

from shopgrain.llm import topk
from tests.llm.tools import rows_of

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20):
    ok = [
        (n, i, [int(np.floor(64 * float(np.float32(x)))) for x in v])
        for n, (i, v, _) in enumerate(rows)
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for n, i, v in ok:
        if i % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, j, w in ok if m != n and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("cells", [topk.SHARD_CELLS, 256])
def test_search(spark, monkeypatch, cells):
    monkeypatch.setattr(topk, "SHARD_CELLS", cells)  # many shards
    monkeypatch.setattr(topk, "BLOCK", 7)
    rng = np.random.default_rng(5)
    rows = [(n - 100, [float(x) for x in rng.normal(0, 0.3, 8)], 1) for n in range(700)]
    rows += [(1000 + n, [0.25] * 8, 1) for n in range(60)]  # ties
    rows += [(2000, None, 1), (2020, [1.0] * 7 + [None], 1), (2040, [float("nan")] * 8, 1), (2060, [float("inf")] * 8, 1)]
    rows += [(2080, [1.0, 2.0], 1), (2081, [3.0, 4.0], 1), (2100, [], 1), (2101, [], 1), (None, [0.5] * 8, 1), (2120, [1.0] * 3, 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS size", "'x' AS row", "2 AS score").repartition(4)
    assert rows_of(topk.top_inner_products(df), "query_id", "rank", "vec_id", "score") == brute(rows)


def test_repeated_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1)]
    got = topk.top_inner_products(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == [(0, 1, 1, 8192)] * 2 + [(0, 2, 0, 4096)] * 2


def test_empty_table(spark):
    assert topk.top_inner_products(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("seed", range(12))
def test_a_tree_finds_what_looking_at_all_finds(seed):
    rng = np.random.default_rng(seed)
    n, d = int(rng.integers(1, 400)), int(rng.integers(0, 9))
    points = rng.integers(-(2**40), 2**40, (n, d)) if seed % 4 == 0 else rng.integers(-40, 40, (n, d))
    if seed % 3 == 0:
        points[n // 2 :] = points[0]
    order, leaves, centres, radii, parents = topk.ball_tree(points)
    assert sorted(order.tolist()) == list(range(n))
    ids = rng.integers(0, 10**6, n)
    tree = {"points": points[order], "rows": np.arange(n)[order], "ids": ids[order], "leaves": leaves, "centres": centres, "radii": radii, "parents": parents}
    for q, (found, scores) in enumerate(topk.search(points, np.arange(n), np.full(n, -np.inf), tree, 20)):
        want = sorted((-sum(int(a) * int(b) for a, b in zip(points[q], points[j])), int(ids[j])) for j in range(n) if j != q)
        assert [(-int(s), int(i)) for i, s in zip(found, scores)] == want[:20]


def test_hopeless_leaves_are_not_opened():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.integers(-3, 3, (2000, 4)), rng.integers(97, 103, (100, 4))])
    order, leaves, centres, radii, parents = topk.ball_tree(points)
    opened = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, (int, np.integer)):
                opened.append(int(key))
            return super().__getitem__(key)

    tree = {"points": points[order], "rows": np.arange(2100)[order], "ids": np.arange(2100)[order], "leaves": leaves.view(Watched), "centres": centres, "radii": radii, "parents": parents}
    topk.search(np.array([[100, 100, 100, 100]]), np.array([-1]), np.array([-np.inf]), tree, 20)
    assert len(set(opened)) < len(leaves) / 4
