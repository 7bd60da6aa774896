"""Token counts against a cut that builds the pieces."""

import random
import re

from shopgrain.llm.token_counts import START, Automaton, count_tokens, model_pieces
from shopgrain.llm.vocabulary import read_vocabulary, vocabulary_path
from tests.llm.tools import documents, rows_of


def greedy(word, vocabulary, longest):
    count = 0
    while word:
        size = next((n for n in range(min(len(word), longest), 0, -1) if word[:n] in vocabulary), 0)
        if not size:
            return -1
        word, count = word[size:], count + 1
    return count


def test_any_vocabulary():
    rng = random.Random(1)
    for _ in range(400):
        vocabulary = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 14))}
        vocabulary |= {"_" + x for x in rng.sample(sorted(vocabulary), min(3, len(vocabulary)))} | ({"_"} if rng.random() < 0.8 else set())
        automaton = Automaton(vocabulary, "_")
        for _ in range(20):
            word = "".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randint(1, 12)))
            assert automaton.count(word) == greedy("_" + word, vocabulary, 5)


def test_counts(spark):
    texts = ["Hello, world", None, "", " \n\t\x0b", "日本 \U0001f600 ß", "a" * 4000, "word " * 3000, "a\xa0b\x1cc", "the the THE"]
    rows = [(n, t) for n, t in enumerate(texts)] + [(None, "x"), (0, "Hello, world")]
    pieces = set(model_pieces(read_vocabulary(vocabulary_path("piece_bpe_32k.model"))))
    longest = max(map(len, pieces))
    want = []
    for d, t in rows:
        counts = [greedy(START + w, pieces, longest) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        want.append((d, len(counts), sum(max(c, 1) for c in counts), sum(c < 0 for c in counts)))
    got = count_tokens(documents(spark, rows, clash=True))
    assert rows_of(got, "doc_id", "n_words", "n_tokens", "n_unknown") == sorted(want, key=repr)


def test_empty_table(spark):
    assert count_tokens(documents(spark, [])).collect() == []
