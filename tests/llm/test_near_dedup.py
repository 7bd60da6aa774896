"""Near duplicates against brute force."""

import random
import re

import numpy as np

from shopgrain.llm import near_dedup
from shopgrain.llm.graph import components
from shopgrain.llm.text import parts, shingles, word_hashes
from tests.llm.tools import documents, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, share=85):
    """(doc_id, n_shingles, component_id, kept) of rows with different ids."""
    sets = {d: word_sets(t) for d, t in rows}
    component = {d: d for d in sets}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b])
    ]
    while True:
        moved = False
        for a, b in links:
            low = min(component[a], component[b])
            moved |= component[a] != low or component[b] != low
            component[a] = component[b] = low
        if not moved:
            break
    return sorted(((d, len(s), component[d], component[d] == d) for d, s in sets.items()), key=repr)


def drifting_copies(rng, n, length=120, edits=3):
    """Copies of copies, so that a group is one component though its ends differ."""
    vocabulary = [f"w{i}" for i in range(500)]
    texts = [[rng.choice(vocabulary) for _ in range(length)]]
    for _ in range(n - 1):
        words = list(rng.choice(texts))
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(length)] = rng.choice(vocabulary)
        texts.append(words)
    return [" ".join(t) for t in texts]


def test_groups_equal_brute_force(spark):
    rng = random.Random(4)
    texts = drifting_copies(rng, 260) + drifting_copies(rng, 30, 40, 2)  # the first takes three blocks
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(12))) for _ in range(120)]
    texts += [texts[0].upper(), texts[0] + "\n", "One two", "one\ttwo", "one two three four five", None, "", " \n ", None]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = near_dedup.near_duplicates(documents(spark, rows, clash=True))
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute(rows)


def test_repeated_rows_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(5, long), (5, long), (None, long), (None, "alone in the world"), (9, None), (9, None), (5, "another text")]
    got = near_dedup.near_duplicates(documents(spark, rows))
    assert rows_of(got, "doc_id", "component_id", "kept") == sorted(
        [(5, 5, True)] * 3 + [(None, 5, False), (None, None, True)] + [(9, 9, True)] * 2, key=repr
    )


def test_empty_table(spark):
    assert near_dedup.near_duplicates(documents(spark, [])).collect() == []


def test_every_coordinate_of_a_sketch_is_filled_and_agreement_is_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    other = np.concatenate([base[:340], rng.integers(0, 1 << 63, 60, dtype=np.uint64)])
    sketches = near_dedup.sketch([base, other, base[:1], base[:3]])
    assert (sketches != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    agreed = (sketches[0] == sketches[1]).mean()
    assert abs(agreed - 340 / 460) < 0.12
    alone = near_dedup.sketch([base[:3]])
    assert (alone[0] == sketches[3]).all()  # the batch plays no part


def test_words_do_not_depend_on_how_texts_are_cut():
    texts = [b"", b"One two  three", b"one TWO\x0bthree ", b"x" * 5000 + b" one", "é Ü".encode()]
    whole = {r: h.tolist() for r, h in word_hashes(texts)}
    assert whole[1] == whole[2] and whole[0] == [] and whole[3][-1] == whole[1][0] and len(whole[4]) == 2
    pieces = [(r, b) for bundle in parts(texts, 7) for r, b in bundle]
    assert [b"".join(b for r, b in pieces if r == i) for i in range(len(texts))] == texts
    assert all(len(b) <= 14 or b" " not in b[7:-1] for _, b in pieces)
    assert len(shingles(np.arange(4, dtype=np.uint64), 5)) == 1


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)]
    edges += [(1000, n) for n in range(200, 300)]  # a node that most edges share
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in range(100):
        for a, b in edges:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want
