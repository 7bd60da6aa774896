"""Packing: ids against the tokenizer, places against a plain best fit."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from shopgrain.llm.packing import best_fit, pack, sequences
from shopgrain.llm.vocabulary import vocabulary_path
from tests.llm.tools import documents


@pytest.mark.parametrize("seed", range(60))
def test_the_tightest_window_is_taken(seed):
    rng = random.Random(seed)
    window = rng.choice([1, 2, 7, 8, 31, 64])
    lengths = sorted((rng.randint(1, window) for _ in range(rng.randrange(80))), reverse=True)
    filled = {}
    for length, number, offset in zip(lengths, *best_fit(lengths, window)):
        rooms = [window - f for f in filled.values() if window - f >= length]
        assert offset == filled.get(number, 0)
        assert window - offset == (min(rooms) if rooms else window)
        filled[number] = offset + length
    assert all(f <= window for f in filled.values())


TEXTS = [
    "Hello, World... it's FINE.", None, "", "word " * 5000, "<|endoftext|> x<|startoftext|>. <|ENDOFTEXT|>",
    "ΣΑΣ. é é. İstanbul 한국어, 日本 ½. 12. ²! ß&&& ", "a\x1cb\x85c\xa0d e", "\x00 \x0b\x0c", "same", "same",
    "w" * 3000, "don't we'LL 'S. .'s",
]


def test_every_id_is_in_one_piece(spark):
    rows = [(n, t) for n, t in enumerate(TEXTS)] + [(None, "null id"), (3, "an id again")]
    window = 64
    got = pack(documents(spark, rows, clash=True), window=window, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    want = sorted(
        ((d, *tokenizer.encode(t or "", add_special_tokens=False).ids, 1) for d, t in rows), key=repr
    )
    by_doc = {}
    for r in sorted(got, key=lambda r: r.start):
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    joined = sorted(((k[0], *[i for r in v for i in r.ids]) for k, v in by_doc.items()), key=repr)
    assert joined == want
    filled = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    for r in got:
        n = filled[r.sequence_id]
        assert n <= window and r.padded_length == (n if n & (n - 1) == 0 else window)


def test_sequences(spark):
    pieces = pack(documents(spark, [(1, "a b c"), (2, "d " * 40)]), window=16, with_ids=True)
    whole = {r.sequence_id: r for r in sequences(pieces).collect()}
    for r in pieces.collect():
        assert whole[r.sequence_id].ids[r.offset : r.offset + r.length] == r.ids


def test_many_documents_leave_little_room(spark):
    rng = random.Random(3)
    rows = [(n, "word " * rng.randrange(3000)) for n in range(400)]
    got = pack(documents(spark, rows)).collect()
    used = sum(r.length for r in got)
    assert len({r.sequence_id for r in got}) * 2048 < used * 1.02 + 2048


def test_empty_table(spark):
    assert pack(documents(spark, [])).collect() == []


def test_tokenizers_that_keep_white_space_are_refused(spark):
    with pytest.raises(ValueError, match="word by word"):
        pack(documents(spark, []), vocabulary=vocabulary_path("byte_bpe_50k.json"))
