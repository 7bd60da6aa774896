"""Importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from shopgrain.llm import resampling
from tests.llm.tools import documents, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ("doc_id", "n_words", "n_features", "weight", "score", "rank")


def grams(text, longest):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, longest=1, buckets=10_000, percent=10, least=20, seed="2024"):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, text in rows for f in grams(text, longest)[1])
    t = Counter(bucket(f) for text in target for f in grams(text, longest)[1])
    more, less = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * more / ((s[b] + 1) * less))) for b in range(buckets)}
    out = []
    for doc, text in rows:
        n, found = grams(text, longest)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, n, len(found), weight, weight + noise, None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = i + 1
    return sorted(map(tuple, out), key=repr)


def made(rng, n):
    vocabulary = [f"w{i}" for i in range(300)] + ["été", "日本", "naïve", "a1b2"]
    lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(9))) for _ in range(60)]
    return [
        (i, "\n".join(rng.choice(lines) + rng.choice(("", "!", ", And", "\r")) for _ in range(rng.randrange(12))))
        for i in range(n)
    ]


@pytest.mark.parametrize("longest", [1, 3])
def test_equals_brute_force(spark, longest):
    rng = random.Random(longest)
    rows = made(rng, 200)
    rows += [(300, None), (301, ""), (302, "\n\n"), (303, "one\ntwo\n\nthree"), (304, "x " * 4000 + "\n"), (305, "nul\x00byte")]
    rng.shuffle(rows)
    target = [t for _, t in made(rng, 20)] + [None, ""]
    got = resampling.resample(
        documents(spark, rows, clash=True),
        spark.createDataFrame([(t,) for t in target], "text string"),
        longest=longest,
        buckets=700,
    )
    want = brute(rows, target, longest, 700)
    assert rows_of(got, *COLUMNS) == want
    assert sum(r[5] is not None for r in want) > 5


def test_repeated_rows_null_ids_and_no_target(spark):
    rows = [(1, "alpha beta " * 15)] * 3 + [(None, "gamma " * 25), (1, "delta " * 30), (2, None), (2, None)]
    got = resampling.resample(documents(spark, rows), spark.createDataFrame([], "text string"), percent=100)
    want = brute(rows, [], percent=100)
    assert [r[:5] for r in rows_of(got, *COLUMNS)] == [r[:5] for r in want]
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == [1, 2, 3, 4, 5]


def test_empty_table(spark):
    none = documents(spark, [])
    assert resampling.resample(none, none).collect() == []


def test_a_line_is_counted_once_for_all_its_places(spark, monkeypatch):
    rows = [(i, f"the same line of many texts\nown {i}") for i in range(50)]
    lines = resampling._distinct_lines(documents(spark, rows).select("text"))
    assert lines.count() == 51 and max(r["times"] for r in lines.collect()) == 50
