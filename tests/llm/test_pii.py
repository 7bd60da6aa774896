"""Personal data: the fixed patterns against plain regular expressions, the field's programming against enumeration."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from shopgrain.llm import pii
from tests.llm.tools import documents

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    def ok(kind, span):
        digits = re.sub("[^0-9]", "", span)
        if kind == "ip":
            return all(int(p) <= 255 for p in span.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and pii.luhn(digits)
        return kind == "email" or 9 <= len(digits) <= 15

    return {k: [m.span() for m in re.finditer(p, text) if ok(k, m[0])] for k, p in PATTERNS.items()}


PARTS = ["1", "2", "0", "55", ".", "-", " ", "+", "@", "a", "b.c", "(", ")", "é", "_", "255.", "x@y.z", "--", "%", "\n", "9999"]


@pytest.mark.parametrize("seed", range(20))
def test_base_spans(seed):
    rng = random.Random(seed)
    for _ in range(400):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(60)))
        number = "".join(rng.choice("0123456789") for _ in range(rng.randrange(11, 19)))
        check = next(c for c in "0123456789" if pii.luhn(number + c))
        text += f" {number}{check}" + rng.choice(["", " 1", "-2", ".3"])
        assert pii.base_spans(text) == brute(text)


def test_hostile_texts_take_linear_time():
    for unit in ("1", "1.", "1 ", "+", "@", "a@", "+1 ", "1-", "a.", "(at)", "1.1.1.1.", "9999999 "):
        text = unit * 20_000
        base = pii.base_spans(text)
        pii.added_spans(text, base, np.zeros((4, len(pii._NAMES))))


def test_the_best_segmentation_is_found():
    rng = np.random.default_rng(2)
    for text in ("+1 269 555 3296 4524132264652876", "1234567 7654321 12 345 6789", "a.b@c.d e@f.gh"):
        lattice = pii.Lattice(text, 0, len(text))
        scores = rng.normal(0, 2, (len(lattice.spans), 4))

        def valid(chosen):
            spans = sorted(lattice.spans[n] for n in chosen)
            return all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))

        sums, marginal = [], np.zeros_like(scores)
        numbers = range(min(len(lattice.spans), 12))
        lattice.spans, lattice.features, scores = lattice.spans[:12], lattice.features[:12], scores[:12]
        marginal = np.zeros_like(scores)
        for size in range(4):
            for chosen in itertools.combinations(numbers, size):
                if valid(chosen):
                    for kinds in itertools.product(range(4), repeat=size):
                        total = sum(scores[n, k] for n, k in zip(chosen, kinds))
                        sums.append((total, sorted(zip(chosen, kinds))))
                        for n, k in zip(chosen, kinds):
                            marginal[n, k] += np.exp(total)
        best = max(sums, key=lambda s: s[0])
        assert sorted(pii.best_segments(lattice, scores)) == best[1]
        if len(lattice.spans) and not any(valid(c) for c in itertools.combinations(numbers, 4)):
            whole = sum(np.exp(t) for t, _ in sums)
            assert np.allclose(pii.expected(lattice, scores), marginal / whole)


def filler(rng):
    return " ".join(rng.choice(["lo", "mira", "tex", "und", "par"]) for _ in range(8))


def sample(rng, n):
    out = []
    for _ in range(n):
        card = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        card += next(c for c in "0123456789" if pii.luhn(card + c))
        phone = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        ip = ".".join(str(rng.randrange(256)) for _ in range(4))
        what = rng.choice([card, phone, ip, f"user{rng.randrange(99)}@mail.example.org", str(rng.randrange(10**9, 10**12))])
        out.append(f"{filler(rng)} {what} {filler(rng)}")
    return out


def test_what_the_patterns_run_together_is_told_apart(spark):
    rng = random.Random(1)
    texts = sample(rng, 600) + [f"x +1 (269) 555-3296 4524132264652876 y", filler(rng), None, "", "no 1234567 data", "z " * 60_000]
    rows = list(enumerate(texts)) + [(None, texts[0]), (0, texts[0])]
    got = pii.personal_data(documents(spark, rows, clash=True)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for d, text in rows:
        base = brute(text or "")
        joined = ",".join(f"{k}:{s}:{e}" for k in pii.KINDS for s, e in base[k])
        assert by_id[d].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert tuple(by_id[d][f"n_{k}"] for k in pii.KINDS) == tuple(len(base[k]) for k in pii.KINDS)
        assert set(filter(None, joined.split(","))) <= set(by_id[d].spans.split(","))
    assert by_id[600].n_phone == by_id[600].n_card == 0
    assert by_id[600].spans == "card:20:36,phone:2:19"
    assert sum(r.n_added for r in got) == 2


def test_the_sample_reaches_its_bound(spark, monkeypatch):
    """Rows that cannot hold personal data, and copies, take nothing from it."""
    rows = [(n, "no such thing here") for n in range(5000)] + [(n, "call +49 30 1234567 now") for n in range(500)]
    rows += [(n, f"write to a{n}@example.org") for n in range(300)]
    seen = []
    monkeypatch.setattr(pii, "SAMPLE_ROWS", 200)
    monkeypatch.setattr(pii, "train", lambda texts: seen.append(len(texts)))
    pii.learn(documents(spark, rows))
    assert 150 < seen[0] <= 400


def test_empty_table_and_nothing_to_learn(spark):
    assert pii.personal_data(documents(spark, [])).collect() == []
    got = pii.personal_data(documents(spark, [(1, "plain"), (2, None)])).collect()
    assert {(r.spans, r.n_added, r.base_sha256) for r in got} == {("", 0, hashlib.sha256(b"").hexdigest())}
