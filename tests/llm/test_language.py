"""Language: held-out accuracy, and inputs that play no part."""

import random
import zlib

import numpy as np

from shopgrain.llm import language
from shopgrain.llm.language import BUCKETS, identify, subwords
from tests.llm.tools import documents

FOLDER = "/root/testdata/sf0.01"
WORDS = {
    "aa": ["lalo", "melu", "olira", "lumo", "ELA"],
    "bb": ["krat", "zwirk", "tschup", "kraz", "Zupt"],
    "cc": ["ñoé", "éña", "çoñ", "éçé", "ñaña"],
}


def text(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = identify(docs, keep=("doc_id", "lang")).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.rejected for r in got]) < 0.01


def test_edges(spark):
    rng = random.Random(1)
    rows = [(n, text(rng, lang, 30), lang, None) for n in range(240) for lang in WORDS if n % 3 == "abc".index(lang[0])]
    odd = [None, "", "12 34 !?", "٣", "²", "krat " * 60_000, "LALO", "日本"]
    rows += [(1000 + n, t, None, None) for n, t in enumerate(odd)] + [(None, "lalo melu lumo", None, None)] * 2
    docs = documents(spark, rows, clash=True)
    got = identify(docs, keep=("doc_id", "lang", "row")).collect()
    assert len(got) == len(rows) and {r.row for r in got} == {"x"}
    by_id = {r.doc_id: r for r in got}
    for n in (1000, 1001, 1002, 1003, 1004):
        assert (by_id[n].lang_pred, by_id[n].score, by_id[n].rejected) == ("und", 0.0, True)
    assert by_id[1005].lang_pred == "bb" and by_id[1006].lang_pred == "aa" and by_id[1007].lang_pred in WORDS
    assert not by_id[None].held_out
    assert all(r.lang == r.lang_pred for r in got if r.lang and r.held_out)


def test_many_labels_and_labels_of_copies(spark):
    rng = random.Random(3)
    made = {f"l{n}": [f"{a}{b}" * 2 for a in rng.sample("abcdefghijklmnopqrstuvwxyz", 3) for b in (n, n + 7)] for n in range(130)}
    rows = [(100 * i + n, " ".join(rng.choice(words) for _ in range(20)), name, None) for i, (name, words) in enumerate(made.items()) for n in range(6)]
    rows += [(50_000 + n, "quex quaz " * 9 + str(n % 5), "copied", None) for n in range(3000)]
    rows += [(60_000 + n, "zorn zirp " * 6000, "long", None) for n in range(900)]  # too long to learn from
    rows += [(70_000 + n, f"zorn zirp zapp {n}", "long", None) for n in range(9)]
    model = language.learn(documents(spark, rows))
    assert set(model.languages) == {*made, "copied", "long"}


def test_class_scores_are_those_of_a_mean_and_a_softmax():
    rng = random.Random(5)
    texts = [text(rng, lang, 12).lower().encode() for lang in WORDS for _ in range(30)]
    model = language.train(texts, [lang for lang in WORDS for _ in range(30)], epochs=2)
    n = len(model.languages)
    for t in texts[::11]:
        found = np.concatenate(list(subwords(language._laid_out([t]))))
        found = found[found < BUCKETS]
        logits = (model.table[found, :n].mean(axis=0) + model.bias) / model.temperature
        want = np.exp(logits) / np.exp(logits).sum()
        assert np.allclose(model.scores([t])[0], want, atol=1e-5)


def test_labels_of_held_out_rows_are_not_used(spark):
    rng = random.Random(1)
    rows = [(n, text(rng, "aa" if n % 2 else "bb", 20), "aa" if n % 2 else "bb", None) for n in range(200)]
    wrong = [(d, t, "zz" if zlib.crc32(str(d).encode()) % 4 == 2 else lang, s) for d, t, lang, s in rows]
    pairs = [
        sorted((r.doc_id, r.lang_pred, r.score) for r in identify(documents(spark, x)).collect()) for x in (rows, wrong)
    ]
    assert pairs[0] == pairs[1]


def test_nothing_to_learn_from(spark):
    got = identify(documents(spark, [(1, "lalo"), (2, None)])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert identify(documents(spark, [])).collect() == []


def test_subwords_lie_inside_words_and_take_their_edges():
    data = np.frombuffer(b" ab 1c    ", np.uint8)
    counts = [int((b < BUCKETS).sum()) for b in subwords(data)]
    assert counts == [5, 3, 1]  # " a" "ab" "b " " c" "c "; " ab" "ab " " c "; " ab "


def test_a_text_in_parts_scores_as_a_whole(monkeypatch):
    rng = random.Random(5)
    texts = [text(rng, lang, 40).encode() for lang in WORDS for _ in range(30)]
    model = language.train(texts, [lang for lang in WORDS for _ in range(30)])
    long = (text(rng, "cc", 3000)).encode()
    whole = model.scores([long, texts[0]])
    cut = language.parts
    monkeypatch.setattr(language, "parts", lambda texts, size: cut(texts, 1000))
    assert np.allclose(model.scores([long, texts[0]]), whole, atol=1e-3)


def test_what_was_not_learned_is_rejected(spark):
    rng = random.Random(2)
    for known in (["aa"], ["aa", "bb"]):
        rows = [(n, text(rng, known[n % len(known)], 30), known[n % len(known)], None) for n in range(300)]
        rows += [(1000 + n, text(rng, "cc", 30), None, None) for n in range(50)]
        rows += [(2000 + n, " ".join("qxzjvwkpf"[rng.randrange(9):] * 2 for _ in range(15)), None, None) for n in range(50)]
        got = identify(documents(spark, rows)).collect()
        assert {r.doc_id for r in got if r.rejected} == {r[0] for r in rows if r[0] >= 1000}


def test_a_given_language_without_labels_is_rejected(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    hidden = docs.selectExpr("doc_id", "text", "nullif(lang, 'es') AS lang")
    for learned in (("de", "en", "fr"), ("en", "fr")):
        got = identify(hidden.where(f"lang IS NULL OR lang IN {learned}"), keep=("doc_id", "lang")).collect()
        assert np.mean([r.rejected for r in got if r.lang is None]) > 0.95
        assert np.mean([r.rejected for r in got if r.lang is not None]) < 0.01
