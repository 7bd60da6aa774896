"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shopgrain.llm import spelling
from tests.llm.tools import documents, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows, dropping=0, shortest=7, least=2):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            if dropping:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                if h % dropping == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least and len(w) >= shortest}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def brute_groups(words, ratio=10):
    near = defaultdict(list)
    for a in words:
        for b in words:
            if one_edit(a, b):
                near[a].append(b)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o))
        if words[best] >= ratio * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, n, len(near[w]), form.get(w), words.get(form.get(w)), root))
    return sorted(out, key=repr)


COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def made_words(rng, n, letters="abé", shortest=7, longest=11):
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(shortest, longest))) for _ in range(n)]


def test_documents_equal_brute_force(spark):
    rng = random.Random(3)
    vocabulary = made_words(rng, 60) + made_words(rng, 40, "stringeölh")
    rows = []
    for i in range(150):
        words = [rng.choice(vocabulary[: rng.choice((3, 30, 100))]) for _ in range(30)]
        words = [w.upper() if rng.random() < 0.1 else w for w in words]
        rows.append((i, rng.choice((" ", ", ", "-", "_1")).join(words)))
    rows += [(500, None), (501, ""), (502, "x×y÷zab x×y÷zab"), (503, "ŁongWord1LongWord"), (None, vocabulary[0]), (7, rows[7][1])]
    words = brute_words(rows, 31)
    got = spelling.spelling_variants(documents(spark, rows, clash=True), dropping=31)
    assert rows_of(got, *COLUMNS) == brute_groups(words)
    assert any(r[3] for r in brute_groups(words))


def test_dense_words_and_long_chains(spark):
    rng = random.Random(5)
    words = {w: rng.choice((2, 3, 30, 400, 5000)) for w in made_words(rng, 700, "ab", 7, 11)}
    words |= {"chainaaaa"[:i] + "x" * (9 - i): 10 ** (i - 2) * 2 for i in range(3, 9)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelling.group_variants(df)
    assert rows_of(got, *COLUMNS) == brute_groups(words)


@pytest.mark.parametrize("frequent", [0, 2, 10, 1000])
def test_an_edit_changes_no_more_grams_than_the_bound(frequent):
    rng = random.Random(frequent)
    words = made_words(rng, 300, "abc")
    grams = spelling.Grams(words, 5, frequent)
    for word in words[:150]:
        cut, bound = grams.cut(word)
        assert bound < len(cut) == len(word) - 1
        mine = {g for g in grams.listed(word)}
        for _ in range(40):
            i, c = rng.randrange(len(word)), rng.choice("abcd")
            other = rng.choice((word[:i] + c + word[i + 1 :], word[:i] + word[i + 1 :], word[:i] + c + word[i:], word + c))
            if other == word or len(other) < 6:
                continue
            shift = len(other) - len(word)
            theirs = set(grams.cut(other)[0])
            common = sum((g, p) in theirs or (g, p + shift) in theirs for g, p in cut)
            assert common >= len(cut) - bound
            if len(other) >= 7:
                other_listed = set(grams.listed(other))
                assert any((g, p) in other_listed or (g, p + shift) in other_listed for g, p in mine)


def test_grams_are_divided_where_they_are_frequent():
    grams = spelling.Grams(["station"] * 50 + ["stacked"] * 3 + ["zebra"], 5, 40)
    assert "stati" in grams.counts and "ze" in grams.counts and "zeb" not in grams.counts
    assert grams.cut("zebra")[0] == [("ze", 0), ("eb", 1), ("br", 2), ("ra", 3)]
    assert grams.cut("station")[0][0] == ("stati", 0)


def test_empty_table_long_text_and_short_words(spark):
    assert spelling.spelling_variants(documents(spark, [])).collect() == []
    text = "wording " * 200_000 + "wordings wordings"  # more than a piece
    got = spelling.spelling_variants(documents(spark, [(1, text)]))
    assert rows_of(got, *COLUMNS) == [
        ("wording", 200_000, 1, None, None, "wording"), ("wordings", 2, 1, "wording", 200_000, "wording")
    ]
    with pytest.raises(ValueError):
        spelling.near_pairs(spark.createDataFrame([("ab", 2)], "word string, n long"), 3)


def test_pairs_come_once(spark):
    words = spark.createDataFrame([("variants", 2), ("variant", 5), ("variand", 3), ("elsewhere", 9)], "word string, n long")
    pairs = spelling.near_pairs(words).select(F.least("a", "b"), F.greatest("a", "b"))
    assert sorted(map(tuple, pairs.collect())) == [("variand", "variant"), ("variant", "variants")]
