"""Linked documents against brute force."""

import random
import re

import numpy as np
import pytest

from shopgrain.llm import jaccard_join
from shopgrain.llm.text import shingles
from tests.llm.test_near_dedup import drifting_copies
from tests.llm.tools import documents, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ("doc_id", "n_shingles", "component_id")


def word_sets(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, share=90, n=3):
    """Of rows with different ids."""
    sets = {d: word_sets(t, n) for d, t in rows}
    component = {d: d for d in sets}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b])
    ]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(component[a], component[b])
            moved |= component[a] != low or component[b] != low
            component[a] = component[b] = low
    return sorted(((d, len(s), component[d]) for d, s in sets.items()), key=repr)


@pytest.mark.parametrize(("share", "edits"), [(90, 3), (80, 6), (95, 2)])
def test_components_equal_brute_force(spark, share, edits):
    rng = random.Random(share)
    texts = drifting_copies(rng, 150, 120, edits)  # long lists, several rounds
    texts += drifting_copies(rng, 40, 60, 2) + drifting_copies(rng, 40, 12, 2)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} own{i} {rng.random()}" for i in range(45)]  # one passage, too different
    texts += [f"own{i} {passage} {passage} end" for i in range(45)]  # one passage, nearly alike
    texts += [" ".join(rng.choice("abcd") for _ in range(rng.randrange(9))) for _ in range(100)]
    texts += [texts[0].upper(), texts[0] + "\n", "One two", "one\ttwo", "one two three", None, "", " \n ", None]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = jaccard_join.similar_documents(documents(spark, rows, clash=True), share=share)
    assert rows_of(got, *COLUMNS) == brute(rows, share)


def test_groups_of_one_prefix_fall_into_components(spark):
    """Sets of one size that differ behind their prefixes only."""
    rng = random.Random(1)
    texts = []
    for k in range(40):
        words = [f"w{i}" for i in range(400)]
        for i in rng.sample(range(400), 18 if k % 2 else 6):
            words[i] = f"x{k}.{i}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    got = jaccard_join.similar_documents(documents(spark, rows))
    assert rows_of(got, *COLUMNS) == brute(rows)


def test_repeated_rows_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(5, long), (5, long), (None, long + " end"), (None, "alone in the world"), (9, None), (9, None), (5, "another text")]
    got = jaccard_join.similar_documents(documents(spark, rows))
    assert rows_of(got, "doc_id", "component_id") == sorted(
        [(5, 5)] * 3 + [(None, 5), (None, None)] + [(9, 9)] * 2, key=repr
    )


def test_empty_table_long_text_and_bad_share(spark):
    assert jaccard_join.similar_documents(documents(spark, [])).collect() == []
    assert len(jaccard_join.similar_documents(documents(spark, [(1, None), (2, "")])).collect()) == 2
    long = " ".join(str(i) for i in range(200_000))
    got = jaccard_join.similar_documents(documents(spark, [(3, long), (4, long + " more"), (1, "0 1 2")]))
    assert rows_of(got, *COLUMNS) == [(1, 1, 1), (3, 199_998, 3), (4, 199_999, 3)]
    with pytest.raises(ValueError):
        jaccard_join.similar_documents(documents(spark, []), share=0)


def test_prefixes_of_linked_sets_meet_in_any_order():
    rng = np.random.default_rng(3)
    sieve = jaccard_join.Sieve(np.zeros(0, np.int64), np.zeros(0, np.uint64))
    sieve.table[:] = rng.integers(0, 1 << 63, len(sieve.table), dtype=np.uint64)  # any classes at all
    for n in (1, 5, 9, 10, 11, 57, 300):
        words = rng.integers(1, 1 << 63, n + 2, dtype=np.uint64)
        whole = shingles(words, 3)
        for lost in range(len(whole) // 9 + 1):
            part = np.delete(whole, rng.choice(len(whole), lost, replace=False)) if lost else whole
            if not len(part) or 100 * len(part) < 90 * len(whole):
                continue
            first = [sieve.ordered(s)[: jaccard_join.prefix_length(len(s), 90)] for s in (whole, part)]
            assert set(first[0].tolist()) & set(first[1].tolist())
            apart = np.bitwise_count(jaccard_join.parity(whole) ^ jaccard_join.parity(part)).sum()
            assert apart <= lost
