"""Spelling variants: words one edit apart, found by an index of grams of variable length.

A dictionary of grams is fitted on a bounded sample of the words: every gram of two
characters belongs to it, and a gram that is frequent in the sample is divided into
its extensions by one character, up to a longest length. A word has a gram at each of
its places: the longest of the dictionary that begins there. One edit changes only
the grams that hold its place, or end right before it and could be longer; the most
that any place changes is the word's bound. All other grams, with their places, are
also grams of each word one edit away. So a word needs to be looked up only under
``bound + 1`` of its grams, the rarest ones: the long lists are never merged. What
lists have in common is verified by edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.arrow import by_bytes, slices, small_batches
from shopgrain.sources.scratch import settle

SHORTEST, LEAST, RATIO = 7, 2, 10
#: Words that the gram dictionary is fitted on, by hash; grams more frequent in them than FREQUENT are divided.
SAMPLE, FREQUENT = 100_000, 40
SHORT_GRAM, LONG_GRAM = 2, 5

_OTHER = re.compile("[^a-zÀ-ÿ]")


# -- words -------------------------------------------------------------------


def _pieces(text: str, size: int = 1 << 20) -> Iterator[str]:
    """A text in pieces of about ``size`` characters that cut no run."""
    at = 0
    while len(text) - at > size:
        found = _OTHER.search(text, at + size)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def _counting(shortest: int, dropping: int):
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % shortest)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            seen: Counter[str] = Counter()
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if not text:
                    continue
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for piece in _pieces(text.encode().lower().decode()):  # of bytes, only A-Z are lower-cased
                    held = runs.findall(piece)
                    if not dropping:
                        seen.update(held)
                        continue
                    for run, times in Counter(held).items():
                        h = zlib.crc32(run.encode(), start)
                        if h % dropping == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < shortest:
                                continue
                        seen[run] += times
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"]
            )

    return task


def count_words(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shortest: int = SHORTEST,
    least: int = LEAST,
    dropping: int = 0,
) -> DataFrame:
    """word, n: the words of all whole texts with at least ``shortest`` code points and ``least`` occurrences.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z as a-z. With
    ``dropping``, a run loses its code point number h % length in the documents
    where h, the CRC-32 of ``<doc_id>:<run>``, is divisible by it: misspellings that
    depend on nothing else. A null doc_id counts as an empty one; null and empty
    texts have no words; rows that repeat count again. Other columns are not read.
    """
    wanted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = wanted.mapInArrow(_counting(shortest, dropping), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# -- grams -------------------------------------------------------------------


class Grams:
    """The gram dictionary: grams longer than SHORT_GRAM by their frequency in the sample, and which are divided."""

    def __init__(self, words: Iterable[str], longest: int = LONG_GRAM, frequent: int = FREQUENT):
        words = list(words)
        self.longest = longest
        self.counts = Counter(w[p : p + SHORT_GRAM] for w in words for p in range(len(w) - SHORT_GRAM + 1))
        level = {g for g, n in self.counts.items() if n > frequent}
        self.divided: set[str] = set()
        for n in range(SHORT_GRAM + 1, longest + 1):
            longer = Counter(
                w[p : p + n] for w in words for p in range(len(w) - n + 1) if w[p : p + n - 1] in level
            )
            longer = {g: k for g, k in longer.items() if k > 1}
            self.divided |= {g[:-1] for g in longer}
            self.counts.update(longer)
            level = {g for g, k in longer.items() if k > frequent}

    def cut(self, word: str) -> tuple[list[tuple[str, int]], int]:
        """The grams of a word with their places, and the most of them that one edit changes."""
        grams, changed, length = [], [0] * (len(word) + 1), len(word)
        for p in range(length - SHORT_GRAM + 1):
            end, most = p + SHORT_GRAM, min(length, p + self.longest)
            while end < most and word[p:end] in self.divided and word[p : end + 1] in self.counts:
                end += 1
            gram = word[p:end]
            grams.append((gram, p))
            # A gram that could be longer also changes with the character after it.
            for i in range(p, min(end + (gram in self.divided), length)):
                changed[i] += 1
        return grams, max(changed)

    def listed(self, word: str) -> list[tuple[str, int]]:
        """The rarest grams of a word: a word one edit away is listed under one of them, too."""
        grams, bound = self.cut(word)
        counts = self.counts
        grams.sort(key=lambda g: (counts.get(g[0], 0), *g))
        return grams[: bound + 1]


def _letters(word: str) -> int:
    """One bit for each letter, by whether the word has it an odd number of times; an edit changes two at most."""
    bits = 0
    for c in word:
        bits ^= 1 << (ord(c) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def _listing(shared):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = shared.value
        for batch in slices(batches, 4096):
            words = batch.column("word").to_pylist()
            listed = [grams.listed(w) for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("word"),
                    batch.column("n"),
                    pa.array(list(map(len, words)), pa.int32()),
                    pa.array(list(map(_letters, words)), pa.int64()),
                    pa.array([[g for g, _ in row] for row in listed], pa.list_(pa.string())),
                    pa.array([[p for _, p in row] for row in listed], pa.list_(pa.int32())),
                ],
                ["word", "n", "length", "letters", "grams", "places"],
            )

    return task


def near_pairs(words: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """a, a_n, b, b_n: every pair of words exactly one inserted, deleted or replaced code point apart, once.

    ``words`` (word, n) are distinct and have at least ``shortest`` >= 4 code points.
    """
    if shortest < SHORT_GRAM + 2:
        raise ValueError("words need four code points to have a gram that an edit leaves alone")
    spark = words.sparkSession
    rate = max(1, SAMPLE) / max(words.count(), 1)
    drawn = words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(rate * (1 << 20)) + 1).select("word")
    # An edit changes no more grams than the longest has characters; a word has one less gram than characters.
    grams = Grams((r["word"] for r in drawn.collect()), min(LONG_GRAM, shortest - SHORT_GRAM))
    shared = spark.sparkContext.broadcast(grams)
    listed = settle(
        words.select("word", "n").mapInArrow(
            _listing(shared),
            "word string, n long, length int, letters long, grams array<string>, places array<int>",
        ),
        "grams",
    )
    each = listed.select(
        "word", "n", "length", "letters", F.explode(F.arrays_zip("grams", "places")).alias("g")
    ).select("word", "n", "length", "letters", F.col("g.grams").alias("gram"), F.col("g.places").alias("place"))

    def key(length, place):
        return F.xxhash64("gram", length, place)

    # A word looks among words of its own length, and of one more: there a gram stands at the same place or one later.
    longer = F.col("length") + 1
    looking = each.select(
        *[F.col(c).alias(f"a_{c}" if c != "word" else "a") for c in ("word", "n", "length", "letters")],
        F.explode(
            F.array(key("length", "place"), key(longer, "place"), key(longer, F.col("place") + 1))
        ).alias("key"),
    )
    lists = each.select(
        *[F.col(c).alias(f"b_{c}" if c != "word" else "b") for c in ("word", "n", "length", "letters")],
        key("length", "place").alias("key"),
    )
    once = ((F.col("a_length") == F.col("b_length")) & (F.col("a") < F.col("b"))) | (
        F.col("a_length") + 1 == F.col("b_length")
    )
    alike = F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2
    return (
        looking.join(lists, "key")
        .where(once & alike)
        .where(F.levenshtein("a", "b", 1) == 1)
        .select("a", "a_n", "b", "b_n")
        .dropDuplicates(["a", "b"])
    )


# -- groups ------------------------------------------------------------------


def group_variants(words: DataFrame, shortest: int = SHORTEST, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of ``words`` (word, n; distinct).

    ``n_near`` counts the words one edit away. ``form`` is the one of them with the
    largest n (ties: smallest in code-point order), if that is at least ``ratio``
    times the word's own; ``root`` is where forms lead to in the end, the word itself
    without a form. An empty table gives no rows.
    """
    words = settle(words.select("word", "n"), "words")
    pairs = settle(near_pairs(words, shortest), "near")
    both = pairs.select("a", "a_n", "b", "b_n").union(pairs.select("b", "b_n", "a", "a_n")).toDF("of", "of_n", "near", "near_n")
    best = both.groupBy("of", "of_n").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    formed = settle(
        best.select(
            F.col("of").alias("word"),
            "n_near",
            F.when(-F.col("best.less") >= ratio * F.col("of_n"), F.col("best.near")).alias("form"),
            F.when(-F.col("best.less") >= ratio * F.col("of_n"), -F.col("best.less")).alias("form_n"),
        ),
        "formed",
    )
    roots = _roots(formed.where("form IS NOT NULL").select("word", "form"))
    near = formed.join(roots, "word", "left")
    return words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        "form",
        "form_n",
        F.coalesce("root", "word").alias("root"),
    )


def _roots(forms: DataFrame) -> DataFrame:
    """word, root. A form is ``ratio`` times as frequent as its word: the number of rounds is small, and there is no circle."""
    steps = settle(forms, "forms").toDF("at", "to")
    roots = steps.toDF("word", "root")
    while True:
        on = settle(
            roots.join(steps, F.col("root") == F.col("at"), "left").select(
                "word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")
            ),
            "roots",
        )
        roots = on.select("word", "root")
        if on.where("moved").isEmpty():
            return roots


def spelling_variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", dropping: int = 0
) -> DataFrame:
    """The words of all texts (``count_words``) grouped with their variants (``group_variants``)."""
    with small_batches(docs.sparkSession):
        words = settle(count_words(docs, doc_id, text, dropping=dropping), "words")
    return group_variants(words)
