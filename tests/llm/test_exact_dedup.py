"""Exact duplicates against a dictionary of texts."""

import hashlib

import pytest

from shopgrain.llm import exact_dedup
from tests.llm.tools import documents, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BIG = "ab" * (9 * exact_dedup.BLOCK // 2)


@pytest.mark.parametrize("bits", [64, 1])  # one bit: nearly all blocks share their hash
def test_equal_texts(spark, bits):
    texts = ["", None, "A", "a", "É", "é", BIG, BIG.upper(), BIG + "c", "c" + BIG, BIG[:-1] + "x", BIG[: exact_dedup.BLOCK]]
    texts += [BIG[: 2 * exact_dedup.BLOCK], "x" + BIG[1:], BIG + BIG, "a ", " a", "\n", "a\0"] + ["same"] * 9
    rows = list(enumerate(texts))
    groups = {}
    for d, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(d)
    want = sorted(
        (
            (d, max(ids), len(ids), d == max(ids), hashlib.sha256(text.encode()).hexdigest())
            for text, ids in groups.items()
            for d in ids
        ),
        key=repr,
    )
    got = exact_dedup.exact_duplicates(documents(spark, rows, clash=True), hash_bits=bits)
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want


def test_one_row_of_a_group_stays(spark):
    rows = [(4, "t"), (4, "T"), (4, "t"), (None, "t"), (None, "n"), (None, "n"), (4, "other")]
    got = exact_dedup.exact_duplicates(documents(spark, rows)).collect()
    kept = sorted(((r.doc_id, r.group_size) for r in got if r.kept), key=repr)
    assert kept == sorted([(4, 4), (None, 2), (4, 1)], key=repr)
    assert len(got) == 7 and all(r.keep_id == 4 for r in got if r.group_size == 4)


def test_empty_table(spark):
    assert exact_dedup.exact_duplicates(documents(spark, [])).collect() == []
