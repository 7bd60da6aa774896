"""Token counts of greedy longest-match word pieces, without building the pieces.

The vocabulary is a trie. Where a word leaves the trie, a node's failure link leads
to the node that matches what is left once the longest pieces have been taken off
its front, and the number of those pieces is kept with the link. A word's length
in pieces is thus found in one pass over its characters, whatever the pieces are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.arrow import by_bytes
from shopgrain.llm.vocabulary import WordTable, read_vocabulary, split_words, vocabulary_path

VOCABULARY = "piece_bpe_32k.model"
START = "▁"


class Automaton:
    """Counts the pieces of a word: ``start`` + word, cut greedily into the longest known pieces."""

    def __init__(self, pieces: Iterable[str], start: str = START):
        self.start = start
        self.next: dict[int, int] = {}  # node << 21 | code point -> node
        ends, letters = {0}, [(0, 0)]
        for piece in pieces:
            node = 0
            for c in piece:
                step = node << 21 | ord(c)
                found = self.next.get(step)
                if found is None:
                    found = self.next[step] = len(letters)
                    letters.append((node, ord(c)))
                node = found
            ends.add(node)
        self._link(letters, ends)

    def _link(self, letters: list[tuple[int, int]], ends: set[int]) -> None:
        """Failure links and popped counts, shallow nodes first; -1: no cut is possible."""
        depth = [0] * len(letters)
        for node in range(1, len(letters)):
            depth[node] = depth[letters[node][0]] + 1
        self.link, self.popped = [-1] * len(letters), [0] * len(letters)
        for node in sorted(range(1, len(letters)), key=depth.__getitem__):
            if node in ends:
                self.link[node], self.popped[node] = 0, 1
                continue
            parent, code = letters[node]
            at, count = self.link[parent], self.popped[parent]
            while at >= 0:
                to = self.next.get(at << 21 | code)
                if to is not None:
                    self.link[node], self.popped[node] = to, count
                    break
                count += self.popped[at]
                at = self.link[at]

    def count(self, word: str) -> int:
        """The number of pieces, or -1 where the greedy cut meets a place at which no piece begins."""
        step, link, popped = self.next.get, self.link, self.popped
        node = count = 0
        for c in self.start + word:
            code = ord(c)
            to = step(node << 21 | code)
            while to is None:
                count += popped[node]
                node = link[node]
                if node < 0:
                    return -1
                to = step(node << 21 | code)
            node = to
        while node:
            count += popped[node]
            node = link[node]
            if node < 0:
                return -1
        return count


def model_pieces(model: bytes) -> list[str]:
    """The ordinary pieces of a sentencepiece model: no control, unknown and byte pieces."""
    import sentencepiece

    known = sentencepiece.SentencePieceProcessor(model_proto=model)
    return [
        known.id_to_piece(i)
        for i in range(known.get_piece_size())
        if not (known.is_control(i) or known.is_unknown(i) or known.is_byte(i) or known.is_unused(i))
    ]


_counters: dict[str, WordTable] = {}


def _counter(pieces: list[str]) -> WordTable:
    """One table a process: tokens, whether the word is unknown, 1 unless the word is empty."""
    table = _counters.get("\0".join(pieces))
    if table is None:
        automaton = Automaton(pieces)

        def of(words: list[bytes]) -> list[tuple[int, int, int]]:
            counts = [automaton.count(w.decode()) if w else 0 for w in words]
            return [(max(n, 1), int(n < 0), 1) if w else (0, 0, 0) for n, w in zip(counts, words)]

        _counters.clear()
        table = _counters["\0".join(pieces)] = WordTable(of, np.int64)
    return table


def _counted(pieces):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _counter(pieces.value)
        for batch in by_bytes(batches, "text"):
            words, edges, distinct = split_words(batch.column("text"))
            values, _ = table.rows(table.look_up(distinct)[words])
            sums = np.zeros((len(words) + 1, 3), np.int64)
            np.cumsum(values.reshape(-1, 3), axis=0, out=sums[1:])
            tokens, unknown, full = (sums[edges[1:]] - sums[edges[:-1]]).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(np.ascontiguousarray(x)) for x in (full, tokens, unknown))],
                ["doc_id", "n_words", "n_tokens", "n_unknown"],
            )

    return task


def count_tokens(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_tokens, n_unknown of the whole text.

    Words are runs of characters other than 0x20 and 0x09-0x0D. A word is cut,
    with the vocabulary's word mark before it, into the longest pieces from left to
    right; a word that cannot be cut so is one unknown token. The vocabulary is a
    sentencepiece file that the driver reads. Null and empty texts have no words;
    null and repeated ids stay as they are, an empty table gives no rows, other
    columns are not read.
    """
    wanted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    pieces = model_pieces(read_vocabulary(vocabulary or vocabulary_path(VOCABULARY)))
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    kind = wanted.schema["doc_id"].dataType.simpleString()
    return wanted.mapInArrow(_counted(shared), f"doc_id {kind}, n_words long, n_tokens long, n_unknown long")
