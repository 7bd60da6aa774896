"""Words of a text looked up in a table that a task's process keeps and fills as words turn up."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of words and numbers that a process keeps between batches; others are worked out again in the next batch
#: that holds them. A word counts PER_WORD bytes more than its letters, for its places in the tables.
KEPT_BYTES, PER_WORD = 24_000_000, 150
ENCODED = 2_000

#: Signs that a tokenizer of words splits from a letter or digit before them.
_SIGNS = r"([\pL0-9])([.,;:!?%$#*&)]+)"


def vocabulary_path(name: str) -> str:
    """The place of an installed vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read_vocabulary(path: str) -> bytes:
    """A vocabulary file as the driver reads it: a file of a few MB that does not grow with any table."""
    with open(path, "rb") as f:
        return f.read()


class WordTable:
    """Rows of numbers by word. ``of`` turns a list of words into one array of numbers each."""

    def __init__(self, of: Callable[[list[bytes]], Sequence[Sequence[int]]], kind=np.uint32):
        self.of, self.kind = of, kind
        self.place: dict[bytes, int] = {}
        self.values = np.zeros(1 << 16, kind)
        self.starts = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.used = 0
        self.bytes = 0
        self.kept: tuple[int, int] | None = None

    def _add(self, words: list[bytes]) -> None:
        rows = self.of(words)
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.fromiter(chain.from_iterable(rows), self.kind, int(lengths.sum()))
        at, end = len(self.place), self.used + len(flat)
        while len(self.values) < end:
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        while len(self.starts) < at + len(words):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.values[self.used : end] = flat
        self.lengths[at : at + len(words)] = lengths
        self.starts[at : at + len(words)] = self.used + np.cumsum(lengths) - lengths
        self.used = end
        self.bytes += sum(map(len, words)) + len(words) * PER_WORD + len(flat) * self.values.itemsize
        self.place.update(zip(words, range(at, at + len(words))))

    def _trim(self) -> None:
        """Leave the words that came after the table was full."""
        if self.kept is None:
            if self.bytes <= KEPT_BYTES:
                return
            self.kept = (len(self.place), self.used)
        words, used = self.kept
        while len(self.place) > words:
            self.place.popitem()  # the last that came
        self.used = used

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """The place of each of the distinct ``words``; good until the next call."""
        self._trim()
        found = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            found[missing] = np.arange(len(missing)) + len(self.place)
            self._add([words[i] for i in missing.tolist()])
        return found

    def rows(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words, one after another, and where each word's begin (with the end)."""
        lengths = self.lengths[places]
        ends = np.zeros(len(places) + 1, np.int64)
        np.cumsum(lengths, out=ends[1:])
        spots = np.repeat(self.starts[places] - ends[:-1], lengths)
        spots += np.arange(len(spots))
        return self.values[spots], ends


_tables: dict[bytes, WordTable] = {}


def token_table(json_text: bytes) -> WordTable:
    """The token ids of words by a tokenizer file; one table a process."""
    table = _tables.get(json_text)
    if table is None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(json_text.decode())

        def ids(words: list[bytes]) -> list[list[int]]:
            out: list[list[int]] = []
            for at in range(0, len(words), ENCODED):  # what the tokenizer returns is far larger than the ids
                part = [w.decode() for w in words[at : at + ENCODED]]
                out += [e.ids for e in tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            return out

        _tables.clear()
        table = _tables[json_text] = WordTable(ids)
    return table


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The words of all texts as numbers into a list of distinct words, and where each text's begin (with the end).

    Words are divided by 0x20 and 0x09-0x0D. A text without words, or with white
    space at its ends, also has the empty word.
    """
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = split.flatten().cast(pa.binary()).dictionary_encode()
    offsets = split.offsets.to_numpy()
    return coded.indices.to_numpy(), offsets - offsets[0], coded.dictionary.to_pylist()


def simplified(texts: pa.Array) -> pa.Array:
    """Texts whose words repeat more often and have the same ids.

    For tokenizers that lower-case, drop white space and split between letters
    and signs: A-Z becomes a-z (a special token is spelled with <| and would be
    changed or made by that, so then it is left out), and signs are set apart.
    """
    if not pc.any(pc.match_substring(texts, "<|")).as_py():
        texts = pc.ascii_lower(texts)
    return pc.replace_substring_regex(texts, _SIGNS, r"\1 \2")


#: Capitals, accents, signs between, behind and before letters, numbers, several kinds of white space, other scripts.
_PROBE = "The  Cat's  3.5%\tpaid (re-do); Caf\u00e9 $a&b!? x,y.z\n\u6771\u4eac \u00dcber e\u0301 a_b #1 http://a.b/c?d=e ...end "


def check_word_by_word(json_text: bytes) -> None:
    """Raise if a tokenizer file gives other ids for a text than for its words one by one."""
    from tokenizers import Tokenizer

    places, _, words = split_words(simplified(pa.array([_PROBE])))
    table = token_table(json_text)
    ids, _ = table.rows(table.look_up(words)[places])
    if ids.tolist() != Tokenizer.from_str(json_text.decode()).encode(_PROBE, add_special_tokens=False).ids:
        raise ValueError("this tokenizer does not cut a text word by word, lower-cased and split at white space")
