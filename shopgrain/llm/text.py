"""Vectorised work on whole texts inside a task: words, hashes, shingle sets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BREAKS = tuple(bytes([b]) for b in np.flatnonzero(_SPACE))

_MULTIPLIER = 0x9E3779B97F4A7C15
_RANDOM = np.random.default_rng(20240229)
_BYTE_CODES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE_CODES[ord("A") : ord("Z") + 1] = _BYTE_CODES[ord("a") : ord("z") + 1]
_BASE, _BASE_INVERSE = 0xD1342543DE82EF95, pow(0xD1342543DE82EF95, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n-1 modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        factors = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        factors[0] = 1
        have = np.multiply.accumulate(factors)
        if len(have) <= 1 << 20:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def parts(texts: Sequence[bytes], size: int = 1 << 20) -> Iterator[list[tuple[int, bytes]]]:
    """The texts as (row, bytes) in lists of about ``size`` bytes.

    A longer text is cut behind white space, so that no word is cut; its parts
    follow one another. Memory is bounded by ``size`` and the longest word.
    """
    bundle: list[tuple[int, bytes]] = []
    held = 0
    for row, text in enumerate(texts):
        at = 0
        while True:
            end = len(text)
            if end - at > size:
                end = _cut(text, at + size)
            bundle.append((row, text[at:end] if at or end < len(text) else text))
            held += end - at
            at = end
            if held >= size:
                yield bundle
                bundle, held = [], 0
            if at >= len(text):
                break
    if bundle:
        yield bundle


def _cut(text: bytes, at: int) -> int:
    """The first place from ``at`` on that follows white space."""
    step = 1 << 16
    while at < len(text):
        window = np.frombuffer(text, np.uint8, min(step, len(text) - at), at)
        found = np.flatnonzero(_SPACE[window])
        if len(found):
            return at + int(found[0]) + 1
        at += len(window)
    return len(text)


def word_hashes(texts: Sequence[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """For each text its row and the 64-bit hashes of its words, in order.

    Words are runs of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z.
    """
    row, held = -1, []
    for bundle in parts(texts):
        data = np.frombuffer(b" ".join(b for _, b in bundle), np.uint8)
        hashes, starts = _hash_words(data)
        lengths = np.fromiter((len(b) + 1 for _, b in bundle), np.int64, len(bundle))
        edges = np.searchsorted(starts, np.cumsum(lengths)).tolist()
        at = 0
        for (r, _), to in zip(bundle, edges):
            if r != row:
                if row >= 0:
                    yield row, held[0] if len(held) == 1 else np.concatenate(held)
                row, held = r, []
            held.append(hashes[at:to])
            at = to
    if row >= 0:
        yield row, held[0] if len(held) == 1 else np.concatenate(held)


def _hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    change = np.diff(inside)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[data] * powers(_BASE, len(data)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * powers(_BASE_INVERSE, len(data))[starts]
    return mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(_MULTIPLIER)), starts


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``k`` words; of fewer words, the whole as one."""
    n = len(words)
    if not n:
        return words
    width = min(k, n)
    factors = powers(_MULTIPLIER, k + 1)[1:]
    total = np.full(n - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total += words[i : n - width + 1 + i] * factors[i]
    return np.unique(mix(total))
