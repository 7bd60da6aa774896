"""Language of a text by averaged hashed subword embeddings and a linear softmax.

A text's subwords are all runs of 2, 3 and 4 bytes inside its words, the space on
either side of a word included; each is hashed to one of ``BUCKETS`` embeddings,
and the softmax sees their mean over the whole text. The model is trained by
stochastic gradient descent in numpy on a bounded sample of labelled rows: about
``PER_LANGUAGE`` different texts for each label, none longer than ``LONGEST`` bytes,
and about ``SAMPLE_BYTES`` in all. A part of the sample is kept back to calibrate the scores
by a temperature, and to set the bars below which a prediction is rejected.

A softmax over few languages is sure of any text, so there are two bars. One is on
the score; where the kept-back rows are surer, it stays halfway between sure and
even. The other is on familiarity: the share of a text's subwords that training
met in the predicted language, as if ``USUAL_SUBWORDS`` more were as usual there.
It lies under the kept-back rows of that language, the further the fewer they are.

Since the mean and the softmax's weights are both linear, each bucket's share in
every class is worked out once, and a text's class scores are sums of table rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.arrow import by_bytes
from shopgrain.llm.text import parts

BUCKETS, WIDTH, SIZES = 1 << 16, 16, (2, 3, 4)
PER_LANGUAGE, LONGEST, SAMPLE_BYTES = 800, 50_000, 128 << 20
EPOCHS, RATE, SEED = 6, 4.0, 11
REJECTED_SHARE, USUAL_SUBWORDS, FAMILIAR_MARGIN = 0.001, 50, 0.02

_SPACE = 0x20
_LETTERS = np.full(256, _SPACE, np.uint8)
_LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[0x80:] = np.arange(0x80, 0x100)
_MAYBE_LETTER = re.compile(r"[^\W\d_]")


def subwords(data: np.ndarray) -> Iterator[np.ndarray]:
    """For each size the bucket of the run that begins at each byte, ``BUCKETS`` if it is none.

    ``data`` holds texts after one another, each behind a space, and four spaces at the end.
    """
    codes = _LETTERS[data]
    gap = codes == _SPACE
    n = len(codes) - max(SIZES)
    wide = codes.astype(np.uint32)
    for size in SIZES:
        value = np.full(n, size * 0x85EBCA6B & 0xFFFFFFFF, np.uint32)
        for i in range(size):
            value ^= wide[i : n + i] << np.uint32(8 * i)
        value *= np.uint32(0x9E3779B1)
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x2C1B3C6D)
        bucket = (value >> np.uint32(16)).astype(np.int32)
        if size == 2:
            out = gap[:n] & gap[1 : n + 1]
        else:
            out = gap[1 : n + 1].copy()
            for i in range(2, size - 1):
                out |= gap[i : n + i]
        bucket[out] = BUCKETS
        yield bucket


def _laid_out(texts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(b" " + t for t in texts) + b"    ", np.uint8)


def has_letter(text: str | None) -> bool:
    """Whether a character of Unicode's letter categories occurs."""
    return text is not None and any(m[0].isalpha() for m in _MAYBE_LETTER.finditer(text))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # each bucket's share in every class, whether it was met there, and 1 to count it; the last row is 0
    bias: np.ndarray
    usual: np.ndarray  # each class's share of met subwords
    unfamiliar_below: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Calibrated probabilities, a row per text; the text is lower-cased UTF-8."""
        return self._softmax(self._means(self._sums(texts)))

    def judged(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best class, its calibrated probability, and whether the text is rejected, for each text."""
        sums = self._sums(texts)
        chance = self._softmax(self._means(sums))
        best, top = chance.argmax(axis=1), chance.max(axis=1)
        met = sums[np.arange(len(texts)), len(self.languages) + best]
        strange = self.familiarity(met, sums[:, -1], best) < self.unfamiliar_below[best]
        return best, top, strange | (top < self.reject_below)

    def familiarity(self, met: np.ndarray, subwords: np.ndarray, label: np.ndarray) -> np.ndarray:
        return (met + USUAL_SUBWORDS * self.usual[label]) / (subwords + USUAL_SUBWORDS)

    def _means(self, sums: np.ndarray) -> np.ndarray:
        return sums[:, : len(self.languages)] / np.maximum(sums[:, -1:], 1)

    def _sums(self, texts: list[bytes]) -> np.ndarray:
        sums = np.zeros((len(texts), self.table.shape[1]))
        for bundle in parts(texts, (8 << 20) // (self.table.shape[1] + 3)):
            data = _laid_out([t for _, t in bundle])
            starts = np.cumsum([0] + [len(t) + 1 for _, t in bundle[:-1]])
            rows = np.array([r for r, _ in bundle])
            for bucket in subwords(data):
                np.add.at(sums, rows, np.add.reduceat(self.table[bucket], starts, axis=0))
        return sums

    def _softmax(self, means: np.ndarray) -> np.ndarray:
        logits = (means + self.bias) / self.temperature
        out = np.exp(logits - logits.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)


def train(texts: list[bytes], labels: list[str], epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """A model of labelled texts (lower-cased UTF-8); every fifth row is kept back for calibration."""
    languages = sorted(set(labels))
    of = {name: i for i, name in enumerate(languages)}
    random = np.random.default_rng(SEED)
    vectors = random.uniform(-0.5, 0.5, (BUCKETS + 1, WIDTH)).astype(np.float32)
    weights = np.zeros((WIDTH, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    rows = []
    for text, label in zip(texts, labels):
        found, counts = np.unique(np.concatenate(list(subwords(_laid_out([text])))), return_counts=True)
        counts = counts[found < BUCKETS]
        if len(counts):
            rows.append((found[: len(counts)], (counts / counts.sum()).astype(np.float32), of[label], int(counts.sum())))
    kept_back = [r for i, r in enumerate(rows) if i % 5 == 4]
    used = [r for i, r in enumerate(rows) if i % 5 != 4]
    steps, step = max(1, epochs * len(used)), 0
    for _ in range(epochs):
        for k in random.permutation(len(used)):
            found, share, label, _ = used[k]
            speed = rate * (1 - step / steps)
            step += 1
            mean = share @ vectors[found]
            logits = mean @ weights + bias
            wrong = np.exp(logits - logits.max())
            wrong /= wrong.sum()
            wrong[label] -= 1
            back = weights @ wrong
            weights -= speed * np.outer(mean, wrong)
            bias -= 0.01 * speed * wrong
            vectors[found] -= speed * share[:, None] * back
    n = len(languages)
    table = np.zeros((BUCKETS + 1, 2 * n + 1), np.float32)
    table[:BUCKETS, :n] = vectors[:BUCKETS] @ weights
    for found, _, label, _ in used:
        table[found, n + label] = 1
    table[:BUCKETS, -1] = 1
    model = Model(languages, table, bias.astype(np.float64), np.ones(n), np.zeros(n))
    _calibrate(model, kept_back or used)
    _familiarize(model, kept_back)
    return model


def _calibrate(model: Model, rows: list) -> None:
    """The temperature of the best likelihood, and the score under which almost none of ``rows`` falls."""
    if not rows:
        return
    means = np.array([share @ model.table[found, : len(model.languages)] for found, share, *_ in rows])
    labels = np.array([label for _, _, label, _ in rows])
    best = None
    for temperature in np.geomspace(0.05, 5, 60):
        model.temperature = float(temperature)
        chance = model._softmax(means)
        loss = -np.log(np.maximum(chance[np.arange(len(rows)), labels], 1e-9)).mean()
        if best is None or loss < best[0]:
            best = (loss, model.temperature, float(np.quantile(chance.max(axis=1), REJECTED_SHARE)))
    model.temperature = best[1]
    model.reject_below = min(best[2], (1 + 1 / len(model.languages)) / 2)


def _familiarize(model: Model, rows: list) -> None:
    """Each language's usual share of met subwords and its bar, from the rows kept back.

    A new row is less familiar than all of n rows with the chance 1 / (n + 1); by so
    much the bar is lowered. A language without kept-back rows has no bar.
    """
    n = len(model.languages)
    labels = np.array([label for _, _, label, _ in rows], int)
    subwords = np.array([size for *_, size in rows], float)
    met = np.array([size * (share @ model.table[found, n + label]) for found, share, label, size in rows])
    for label in np.unique(labels):
        own = labels == label
        model.usual[label] = met[own].sum() / subwords[own].sum()
        least = np.quantile(model.familiarity(met[own], subwords[own], labels[own]), REJECTED_SHARE)
        model.unfamiliar_below[label] = least - FAMILIAR_MARGIN - 1 / (own.sum() + 1)


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """A model from the rows that have a text and a label and whose crc32(doc_id) mod 4 is not 2."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), doc_number(doc_id).alias("number")).where(
        "text IS NOT NULL AND lang IS NOT NULL AND number % 4 <> 2"
    )
    short = rows.where(F.octet_length("text") <= LONGEST)
    # What can be sampled of each label: copies count once.
    sizes = (
        short.groupBy("lang")
        .agg(F.approx_count_distinct("text").alias("texts"), F.avg(F.octet_length("text")).alias("bytes"))
        .collect()
    )
    if not sizes:
        return None
    wanted = min(PER_LANGUAGE, SAMPLE_BYTES / sum(r["bytes"] for r in sizes))
    rates = [(r["lang"], int(min(1.0, wanted / max(r["texts"], 1)) * (1 << 40))) for r in sizes]
    place = F.pmod(F.xxhash64("text", "lang", F.lit(SEED)), F.lit(1 << 40))
    sample = (
        short.select("lang", "text", place.alias("place"))
        .join(F.broadcast(docs.sparkSession.createDataFrame(rates, "lang string, bar long")), "lang")
        .where("place < bar")
        .select("lang", "text", "place")
        .distinct()
        .orderBy("place", "lang", "text")
        .limit(int(2 * wanted * len(sizes)) + 1)
        .collect()
    )
    if not sample:
        return None
    return train(_lower([r["text"] for r in sample]), [r["lang"] for r in sample])


def doc_number(doc_id: str):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def _lower(texts: list[str | None] | pa.Array) -> list[bytes]:
    column = texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.string())
    return [x or b"" for x in pc.utf8_lower(column).cast(pa.binary()).to_pylist()]


def _predicted(model, keep: list[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model | None = model.value
        for batch in by_bytes(batches, "text", 4 << 20):
            texts = batch.column("text")
            clear = [has_letter(x) for x in texts.to_pylist()]
            names, scores, rejected = ["und"] * len(clear), [0.0] * len(clear), [True] * len(clear)
            if known is not None:
                for i, (best, top, out) in enumerate(zip(*(x.tolist() for x in known.judged(_lower(texts))))):
                    if clear[i]:
                        names[i], scores[i], rejected[i] = known.languages[best], top, out
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep]
                + [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                [*keep, "lang_pred", "score", "rejected"],
            )

    return task


def identify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The language of every whole text, learned from the table's own labels.

    Result: the columns ``keep`` of ``docs``, held_out (crc32(doc_id as text) mod 4
    is 2; such rows are never learned from), lang_pred (a learned label; ``und``
    if the text is null or has no letter, or nothing could be learned), score (0 to
    1; 0 for ``und``) and rejected (``und``, or a score or a share of familiar
    subwords below the calibrated bars).
    A null doc_id counts as the empty text. Repeated rows are predicted alike; of
    the sample they are one row. An empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, doc_id, text, lang))
    fields = [f for f in docs.schema.fields if f.name in keep]
    rows = docs.select(*[F.col(f"`{f.name}`") for f in fields], F.col(text).alias("__text"), (doc_number(doc_id) % 4 == 2).alias("__held"))
    rows = rows.withColumnsRenamed({f.name: f"c{i}" for i, f in enumerate(fields)} | {"__text": "text", "__held": "held_out"})
    names = [f"c{i}" for i in range(len(fields))] + ["held_out"]
    kinds = [f.dataType.simpleString() for f in fields] + ["boolean"]
    out = rows.mapInArrow(
        _predicted(model, names),
        ", ".join(f"{n} {k}" for n, k in zip(names, kinds)) + ", lang_pred string, score double, rejected boolean",
    )
    return out.withColumnsRenamed({f"c{i}": f.name for i, f in enumerate(fields)})
