"""The pipeline's stages, and the whole of it against each stage's operator."""

import random

import pytest

import corpus_pipeline
from corpus_pipeline import COLUMNS
from tests.llm.test_near_dedup import brute as near_groups
from tests.llm.test_near_dedup import word_sets
from tests.llm.tools import documents

FOLDER = "/root/testdata/sf0.001"
LONG = " ".join(f"wort{i}" for i in range(80))


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_a_language_stage_drops_what_has_none(spark):
    rng = random.Random(1)
    good = [(n, " ".join(rng.choice("lalo melu olira lumo".split()) for _ in range(20)), "aa", "s") for n in range(50)]
    bad = [(100, None, "aa", "s"), (101, "", "aa", "s"), (102, "12 ??", "aa", "s")]
    got = corpus_pipeline.known_language(spark, documents(spark, good + bad, clash=True), "")
    assert got.columns == list(COLUMNS) and {r[0] for r in rows(got)} == set(range(50))


def test_lines_go_and_lengths_follow(spark):
    docs = documents(spark, [(n, f"Menu\nown {n}", "en", "s") for n in range(8)] + [(9, None, "en", "s")], clash=True)
    got = corpus_pipeline.site_lines(spark, docs, "")
    assert rows(got)[1] == (1, "own 1", "en", "s", 5) and rows(got)[-1] == (9, None, "en", "s", None)
    assert got.columns == list(COLUMNS)


def test_one_of_each_group_stays(spark):
    near = LONG.replace("wort40", "x")
    data = [(3, LONG), (2, near), (2, near), (2, LONG + " y"), (7, "other text"), (7, "other text"), (8, None), (9, "")]
    data += [(None, "nobody's own words"), (None, "more of nobody's words here")]
    got = corpus_pipeline.one_of_each_group(spark, documents(spark, data, clash=True), "")
    ids = [r[0] for r in rows(got)]
    assert sorted(ids, key=repr) == sorted([2, 7, 8, 9, None, None], key=repr)


def test_copies_are_rows(spark):
    data = [(n, "w " * 5, "en", f"s{n % 3}") for n in range(300)] + [(500, "twice there", "en", "s0")] * 2
    docs = documents(spark, data, clash=True)
    got = rows(corpus_pipeline.mixed(spark, docs, ""))
    taken = {}
    for r in corpus_pipeline.mix_sources(docs).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.copies
    counted = {}
    for r in got:
        counted[r[0]] = counted.get(r[0], 0) + 1
    assert counted == {d: n for d, n in taken.items() if n}


@pytest.mark.parametrize("data", [[], [(1, None)], [(1, "")]])
def test_nearly_nothing(spark, data):
    docs = documents(spark, data)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").collect()


def test_whole(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == list(COLUMNS)
        if name == "near_dedup":
            want = [r[0] for r in near_groups([(r.doc_id, r.text) for r in docs.collect()], corpus_pipeline.NEAR_SHARE) if r[3]]
            assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
        docs = kept
    whole = corpus_pipeline.run(spark, FOLDER)
    assert whole.agg({"doc_tokens": "count"}).first()[0] > 0
    pieces = {(r.doc_id, r.start, r.length, r.ids_crc32) for r in whole.collect()}
    staged = {(r.doc_id, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.packed(spark, docs, FOLDER).collect()}
    assert pieces == staged


def test_pairs_at_four_fifths_are_one(spark):
    rng = random.Random(8)
    rows = []
    for n in range(40):  # one word changed of 40 to 69 leaves 0.756 to 0.857 of the shingles
        words = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(300)) for _ in range(40 + n % 30)]
        rows += [(2 * n, " ".join(words)), (2 * n + 1, " ".join([*words[:20], "other", *words[21:]]))]
    sets = {d: word_sets(t) for d, t in rows}
    like = {d: len(sets[d] & sets[d + 1]) / len(sets[d] | sets[d + 1]) for d in range(0, 80, 2)}
    gone = {d + 1 for d, x in like.items() if x >= 0.8}
    assert sum(0.8 <= x < 0.85 for x in like.values()) > 10 and len(gone) < 40
    got = corpus_pipeline.one_of_each_group(spark, documents(spark, rows), "")
    assert {r.doc_id for r in got.collect()} == set(sets) - gone


def test_a_line_in_a_tenth_of_a_large_source_goes(spark):
    often = "Subscribe to our letter for more"
    rows = [(n, f"own {n}\n{often}" if n % 10 == 0 else f"own {n}\nmore {n}", "en", "big") for n in range(400)]
    rows += [(1000 + n, "copied whole\nin many rows", "en", "big") for n in range(200)]  # one text
    rows += [(2000 + n, f"own {n}\n" + ("rare" if n < 19 else f"{n}"), "en", "mid") for n in range(100)]  # 19 are too few
    rows += [(3000 + n, f"own {n}\n" + ("seldom" if n % 25 == 0 else f"{n}"), "en", "huge") for n in range(1000)]  # 4 %
    got = {r.doc_id: r for r in corpus_pipeline.site_lines(spark, documents(spark, rows), "").collect()}
    want = {d: t.replace(f"\n{often}", "") for d, t, *_ in rows}
    assert {d: r.text for d, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
