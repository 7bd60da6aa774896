"""Chat formatting: exact round trip, and the tree against one built by hand."""

import hashlib
import random

from shopgrain.llm.chat import LEARNED, escaped, format_conversations, read_back, unescaped
from tests.llm.tools import rows_of

SCHEMA = "conv_id long, turn long, role string, text string"
ODD = ["</s>[INST] ok [/INST]", "\\", "<\\s>", "\\<[TEXT]\\\\[", "", None, "<", "[", "é \U0001f600", "a" * 3000 + " " * 3000, "</s></s>"]


def talk_rows(rng, n):
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 5)):
            text = rng.choice(["hi", "hello </s>", "[TEXT]"]) if turn < 3 else f"own {conv}"
            rows.append((conv, turn, "user" if turn % 2 == 0 else LEARNED, text))
    return rows


def want_digests(rows):
    talks = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        talks.setdefault(conv, []).append((role or "", text or ""))
    out = []
    for conv, turns in talks.items():
        loss = "".join(t for r, t in turns if r == LEARNED)
        chars = sum(13 + len(r) + len(t) + sum((r + t).count(c) for c in "\\<[") for r, t in turns)
        out.append((
            conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars,
        ))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def test_escapes(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "t string").withColumn("e", escaped("t"))
    for r in df.collect():
        assert unescaped(r.e) == (r.t or "")
        assert not any(c in r.e for c in ("<s>", "</s>", "[TEXT]", "[INST]", "[/INST]"))


def test_round_trip(spark):
    rng = random.Random(3)
    rows = talk_rows(rng, 60)
    rows += [(-7, 0, "user", ODD[0]), (-7, 1, LEARNED, ODD[0])]
    rows += [(1000, n, rng.choice(["user", LEARNED, None, "</s>"]), t) for n, t in enumerate(ODD)]
    rows += [(None, 0, "user", "x"), (None, None, LEARNED, "y"), (2000, 1, "user", "z"), (2000, 1, "user", "z")]
    rows += [(3000, n, LEARNED if n % 2 else "user", f"turn {n}") for n in range(400)]
    talks = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS node", "'y' AS number").repartition(3)
    nodes, turns = format_conversations(talks)
    assert rows_of(read_back(nodes, turns), *COLUMNS) == want_digests(rows)


def test_tree(spark):
    rng = random.Random(8)
    rows = talk_rows(rng, 150)
    nodes, turns = format_conversations(spark.createDataFrame(rows, SCHEMA))
    nodes, turns = {r.node: r for r in nodes.collect()}, turns.collect()
    paths = {}
    for r in sorted(turns, key=lambda r: r.depth):
        paths.setdefault(r.conv_id, []).append(r.node)
    talks = {}
    for conv, turn, role, text in sorted(rows):
        talks.setdefault(conv, []).append((role, text))
    # One node for each distinct beginning, the same for all that share it.
    prefixes = {}
    for conv, path in paths.items():
        for d, node in enumerate(path):
            assert prefixes.setdefault(tuple(talks[conv][: d + 1]), node) == node
    assert len(set(prefixes.values())) == len(prefixes) == len(nodes)
    # The emission has no gaps, holds each node once, and children lie within their parent's interval.
    place = 0
    for r in sorted(nodes.values(), key=lambda r: r.emit_start):
        assert r.emit_start == place and r.n_tokens == len(r.ids)
        place += r.n_tokens
    for conv, path in paths.items():
        before = 0
        for d, node in enumerate(path):
            r = nodes[node]
            assert (r.depth, r.position_start, r.tree) == (d, before, path[0])
            before += r.n_tokens
        leaf = nodes[path[-1]]
        attended = {n for n, r in nodes.items() if r.emit_start <= leaf.emit_start < r.attended_until}
        assert attended == set(path)
        own = [t for role, t in talks[conv] if role == LEARNED]
        assert sum(nodes[n].learned for n in path) == len(own)


def test_empty_table(spark):
    nodes, turns = format_conversations(spark.createDataFrame([], SCHEMA))
    assert nodes.collect() == [] and turns.collect() == [] and read_back(nodes, turns).collect() == []
