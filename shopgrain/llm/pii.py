"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field beside them.

The patterns give the base spans. The field then reads the zones of a text in
which personal data can lie (runs of digits with their separators, and what stands
around an at sign). A zone is cut into tokens; a segmentation of it takes every
token either alone as other text, with score 0, or as part of an entity of at most
``LONGEST`` tokens and one of the four kinds, whose score is a weighted sum of
features of the whole span: its digits, groups and separators, check sums, its
neighbours and the word before it. Dynamic programming over the segmentations
chooses boundaries and kinds together. Weights are learned by gradient ascent on
the conditional likelihood of a bounded sample of zones whose base spans are the
labels; what the field finds beyond these spans, and away from them, is added.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.arrow import by_bytes

KINDS = ("email", "ip", "card", "phone")
LONGEST = 24
SAMPLE_ROWS, SAMPLE_BYTES = 4000, 50_000
EPOCHS, RATE, SHRINK, SEED = 4, 0.2, 1e-4, 3
#: An added span's score: it is e**MARGIN times as likely as the same text without it.
MARGIN = 3.0

# Fixed patterns of the base spans.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NUMERIC = re.compile(r"[0-9][0-9\x20.()-]*")
_RUNS = re.compile(r"[0-9]+")
_AT = re.compile(r"@|\((?:at|AT)\)|\[(?:at|AT)\]")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")
_WORD_BEFORE = re.compile(r"([A-Za-z]{2,12})[\s:.#=]{0,3}$")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    """Whether the check digit at the end is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c)
        if i % 2:
            x = 2 * x - 9 if x > 4 else 2 * x
        total += x
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The part before the at sign begins where its characters do, or where the last match ended."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The spans of the fixed patterns, leftmost first and without overlap within a kind.

    Digits are looked for once; both number patterns lie within one run of digits
    and separators.
    """
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    found["email"] = list(_emails(text))
    for zone in _NUMERIC.finditer(text):
        if zone.end() - zone.start() < 7:
            continue
        at = zone.start()
        while (start := _RUNS.search(text, at, zone.end())) is not None:  # from run to run: no run is read twice
            m = _IP.match(text, start.start(), zone.end())
            at = m.end() if m else start.end()
            if m and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                found["ip"].append(m.span())
        for m in _CARD.finditer(text, zone.start(), zone.end()):
            if m.end() - m.start() <= 37 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                found["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found["phone"].append(m.span())
    return found


def zones(text: str) -> list[tuple[int, int]]:
    """The parts of a text that are segmented: with seven digits or more, or an at sign in some spelling."""
    out = []
    for m in _NUMERIC.finditer(text):
        end = m.end()
        while not "0" <= text[end - 1] <= "9":
            end -= 1
        if end - m.start() >= 7:
            start = m.start()
            while start and m.start() - start < 2 and text[start - 1] in "+(":
                start -= 1
            out.append((start, end))
    for m in _AT.finditer(text):
        start, end = m.start(), m.end()
        while start and m.start() - start < 64 and (text[start - 1] in _LOCAL or start == m.start() and text[start - 1] == " "):
            start -= 1
        while end < len(text) and end - m.end() < 80 and (text[end] in _LOCAL or end == m.end() and text[end] == " "):
            end += 1
        if start < m.start() and end > m.end():
            out.append((start, end))
    out.sort()
    merged: list[tuple[int, int]] = []
    for start, end in out:
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


_NAMES: dict[str, int] = {}


def _name(feature: str) -> int:
    return _NAMES[feature]


for _f in (
    ["any", "plus", "paren", "space", "dot", "dash", "plain", "luhn", "quad", "quad_over", "at", "at_word", "dotted"]
    + [f"digits_{n}" for n in range(21)]
    + [f"groups_{n}" for n in range(8)]
    + [f"left_{k}" for k in ("edge", "space", "sign", "word")]
    + [f"right_{k}" for k in ("edge", "space", "sign", "word")]
    + [f"before_{n}" for n in range(32)]
):
    _NAMES[_f] = len(_NAMES)


def _beside(c: str) -> str:
    return "edge" if not c else "space" if c.isspace() else "word" if c.isalnum() else "sign"


def span_features(text: str, start: int, end: int) -> list[int]:
    """The features of a whole span that hold."""
    span = text[start:end]
    groups = _RUNS.findall(span)
    digits = sum(map(len, groups))
    out = ["any", f"digits_{min(digits, 20)}", f"groups_{min(len(groups), 7)}"]
    for c, feature in (("(", "paren"), (" ", "space"), (".", "dot"), ("-", "dash"), ("@", "at")):
        if c in span:
            out.append(feature)
    if span[0] == "+":
        out.append("plus")
    if len(groups) == 1 and digits == len(span):
        out.append("plain")
    if 13 <= digits <= 19 and luhn("".join(groups)):
        out.append("luhn")
    if len(groups) == 4 and span == ".".join(groups):
        out.append("quad" if all(len(g) < 4 and int(g) <= 255 for g in groups) else "quad_over")
    if "(at)" in span.lower() or "[at]" in span.lower():
        out.append("at_word")
    at = _AT.search(span)
    if at and "." in span[at.end() :].strip("."):
        out.append("dotted")
    out.append("left_" + _beside(text[start - 1] if start else ""))
    out.append("right_" + _beside(text[end] if end < len(text) else ""))
    before = _WORD_BEFORE.search(text, max(0, start - 16), start)
    if before:
        out.append(f"before_{int.from_bytes(hashlib.md5(before[1].lower().encode()).digest()[:2]) % 32}")
    return [_name(f) for f in out]


class Lattice:
    """The tokens of a zone and the spans that may be entities, by their last token."""

    def __init__(self, text: str, start: int, end: int):
        tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, start, end)]
        self.tokens = tokens
        self.spans: list[tuple[int, int]] = []  # first token, token after the last
        features = []
        digits = [b - a if "0" <= text[a] <= "9" else 0 for a, b in tokens]
        signs = [m.start() for m in _AT.finditer(text, start, end)]
        for i, (a, _) in enumerate(tokens):
            if text[a].isspace() or text[a] in ").-" or (i and digits[i] and text[a - 1] == "+"):
                continue
            held = 0
            for j in range(i, min(i + LONGEST, len(tokens))):
                held += digits[j]
                b = tokens[j][1]
                if held > 19:
                    break
                sign = bisect_right(signs, a)
                mail = sign < len(signs) and signs[sign] < b - 1
                if not (text[b - 1].isalnum() and (held >= 7 or mail or held >= 4 and j - i == 6)):
                    continue
                self.spans.append((i, j + 1))
                features.append(span_features(text, a, b))
        self.features = np.zeros((len(features), len(_NAMES)), np.float32)
        for row, held in enumerate(features):
            self.features[row, held] = 1

    def ending(self) -> list[list[int]]:
        """The numbers of the spans by the token after their last one."""
        out: list[list[int]] = [[] for _ in range(len(self.tokens) + 1)]
        for n, (_, j) in enumerate(self.spans):
            out[j].append(n)
        return out


def best_segments(lattice: Lattice, scores: np.ndarray) -> list[tuple[int, int]]:
    """(span, kind) of the segmentation with the highest score, from left to right."""
    ending = lattice.ending()
    best, back = [0.0] * len(ending), [None] * len(ending)
    for t in range(1, len(ending)):
        best[t] = best[t - 1]
        for n in ending[t]:
            kind = int(scores[n].argmax())
            total = best[lattice.spans[n][0]] + float(scores[n, kind])
            if total > best[t]:
                best[t], back[t] = total, (n, kind)
    out, t = [], len(ending) - 1
    while t > 0:
        if back[t] is None:
            t -= 1
        else:
            out.append(back[t])
            t = lattice.spans[back[t][0]][0]
    return out[::-1]


def _add_logs(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def expected(lattice: Lattice, scores: np.ndarray) -> np.ndarray:
    """The probability of each span and kind over all segmentations."""
    ending = lattice.ending()
    size = len(ending)
    starting: list[list[int]] = [[] for _ in range(size)]
    for n, (i, _) in enumerate(lattice.spans):
        starting[i].append(n)
    whole = [_add_logs(row.tolist()) for row in scores]
    ahead, behind = [0.0] * size, [0.0] * size
    for t in range(1, size):
        ahead[t] = _add_logs([ahead[t - 1]] + [ahead[lattice.spans[n][0]] + whole[n] for n in ending[t]])
    for t in range(size - 2, -1, -1):
        behind[t] = _add_logs([behind[t + 1]] + [behind[lattice.spans[n][1]] + whole[n] for n in starting[t]])
    through = np.array([ahead[i] + behind[j] - ahead[-1] for i, j in lattice.spans])
    return np.exp(scores + through[:, None])


def train(texts: list[str]) -> np.ndarray:
    """Weights by kind and feature, from the zones of ``texts`` and their base spans."""
    examples = []
    for text in texts:
        base = base_spans(text)
        for start, end in zones(text):
            lattice = Lattice(text, start, end)
            if not lattice.spans:
                continue
            ends = {(lattice.tokens[i][0], lattice.tokens[j - 1][1]): n for n, (i, j) in enumerate(lattice.spans)}
            gold, free = [], start
            for s, e, kind in sorted((s, e, k) for k, kind in enumerate(KINDS) for s, e in base[kind]):
                if s >= free and (s, e) in ends:
                    gold.append((ends[s, e], kind))
                    free = e
            examples.append((lattice, gold))
    weights = np.zeros((len(KINDS), len(_NAMES)))
    weights[:, _name("any")] = -2.0
    random = np.random.default_rng(SEED)
    for epoch in range(EPOCHS):
        for k in random.permutation(len(examples)):
            lattice, gold = examples[k]
            wrong = -expected(lattice, lattice.features @ weights.T)
            for n, kind in gold:
                wrong[n, kind] += 1
            weights += RATE / (1 + epoch) * (wrong.T @ lattice.features - SHRINK * weights)
    return weights


def added_spans(text: str, base: dict[str, list[tuple[int, int]]], weights: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of what the field finds away from the base spans."""
    taken = sorted(s for spans in base.values() for s in spans)
    out = []
    for start, end in zones(text):
        if any(s <= start and end <= e for s, e in taken):
            continue
        lattice = Lattice(text, start, end)
        if not lattice.spans:
            continue
        scores = lattice.features @ weights.T
        for n, kind in best_segments(lattice, scores):
            i, j = lattice.spans[n]
            a, b = lattice.tokens[i][0], lattice.tokens[j - 1][1]
            if scores[n, kind] >= MARGIN and not any(s < b and a < e for s, e in taken):
                out.append((kind, a, b))
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def _found(weights):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", 4 << 20):
            counts: list[list[int]] = [[] for _ in KINDS]
            shas, joined, more = [], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                spans = [(k, s, e) for k, kind in enumerate(KINDS) for s, e in base[kind]]
                added = added_spans(text or "", base, weights.value)
                for k, kind in enumerate(KINDS):
                    counts[k].append(len(base[kind]))
                shas.append(hashlib.sha256(_joined(spans).encode()).hexdigest())
                joined.append(_joined(spans + added))
                more.append(len(added))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts)]
                + [pa.array(shas, pa.string()), pa.array(joined, pa.string()), pa.array(more, pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    return task


def learn(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Weights from a sample of about ``SAMPLE_ROWS`` different texts that may hold personal data (all, if there are fewer), none longer than ``SAMPLE_BYTES``, chosen by hash."""
    rows = docs.select(F.col(text).alias("text")).where(
        (F.octet_length("text") <= SAMPLE_BYTES) & F.col("text").rlike(r"@|[0-9][0-9 .()-]{5,}[0-9]")
    )
    total = rows.agg(F.approx_count_distinct("text")).first()[0]
    place = F.pmod(F.xxhash64("text", F.lit(SEED)), F.lit(1 << 40))
    chosen = (
        rows.where(place < int(min(1.0, SAMPLE_ROWS / max(total, 1)) * (1 << 40)))
        .distinct()
        .orderBy(place, "text")
        .limit(2 * SAMPLE_ROWS)
        .collect()
    )
    return train([r["text"] for r in chosen])


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the personal data in its whole text.

    Result: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256
    (lowercase hex of the base spans as kind:start:end in the order of kinds, then
    start, joined by commas; code points, end exclusive), spans (base and added
    ones, joined likewise) and n_added. A null text counts as empty. Repeated rows
    are reported each, null ids stay null, an empty table gives no rows, other
    columns are not read.
    """
    wanted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    weights = docs.sparkSession.sparkContext.broadcast(learn(docs, text))
    kind = wanted.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return wanted.mapInArrow(_found(weights), f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added long")
