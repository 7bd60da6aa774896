"""Conversations as one prefix tree: shared turns are emitted once, depth first.

Each turn is written as ``<s>`` role ``[TEXT]`` text ``</s>``. In roles and texts a
backslash is doubled and one is put behind each ``<`` and ``[``, so that no control
string can come from a text, and the text can be read back.

Conversations that begin with the same turns share the nodes of these turns. A
node is told by its depth and the sums of two hashes of (depth, role, text) over
the turns up to it. All turns are sorted once by conversation and turn; what runs
along a conversation (its turns' numbers, those sums, the tokens before a turn) is
a running sum over the sorted rows minus its value where the conversation begins,
so a conversation of any length is spread over the sort's partitions.

Conversations sorted by the nodes at which they part from others are the tree's
leaves from left to right. The first of those below a node emits the node, the last one
ends it. A token may attend to the tokens of a node if its own place lies in the
node's interval [emit_start, attended_until) and not before the token it attends
to: ancestors and itself, nothing else. That is one interval a node, whatever
the depth. A conversation's sort key has 8 bytes for each node at which another one
leaves it; those others have at least that many turns each, so with n turns in all
no key has more than sqrt(2 n) entries.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopgrain.llm.arrow import by_bytes, slices
from shopgrain.llm.order import numbered
from shopgrain.llm.vocabulary import read_vocabulary, vocabulary_path
from shopgrain.sources.scratch import settle

VOCABULARY = "byte_bpe_50k.tiktoken"
OPEN, BODY, CLOSE = "<s>", "[TEXT]", "</s>"
LEARNED = "assistant"
_MARK = re.compile(r"([<\[])\\|\\(\\)")


def escaped(text: Column) -> Column:
    """Null is empty."""
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescaped(text: str) -> str:
    return _MARK.sub(lambda m: m[1] or m[2], text)


_encodings: dict = {}


def _encoding(ranks: bytes):
    """The byte-level tokenizer of a rank file; one a process."""
    if ranks not in _encodings:
        import public_tokenizers
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        _encodings.clear()
        _encodings[ranks] = tiktoken.Encoding(
            "own",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs},
            special_tokens={},
        )
    return _encodings[ranks]


def _encoded(ranks):
    """node, depth, role, text (escaped) -> also the node's ids, and where those of the text lie among them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _encoding(ranks.value).encode_ordinary
        for batch in by_bytes(batches, "text"):
            heads = [code(f"{OPEN}{role}{BODY}") for role in batch.column("role").to_pylist()]
            bodies = [code(text) for text in batch.column("text").to_pylist()]
            tail = code(CLOSE)
            starts = [len(h) for h in heads]
            ends = [len(h) + len(b) for h, b in zip(heads, bodies)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("node", "depth", "learned")),
                    pa.array([h + b + tail for h, b in zip(heads, bodies)], pa.list_(pa.int32())),
                    pa.array(starts, pa.int64()),
                    pa.array(ends, pa.int64()),
                    pa.array([e + len(tail) for e in ends], pa.int64()),
                ],
                ["node", "depth", "learned", "ids", "body_from", "body_to", "n_tokens"],
            )

    return task


def _along(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Adds running sums, this row included, within each conversation.

    ``rows`` is settled, sorted, with part, place (in the part) and head (the
    number of its conversation's first row) beside number (of the row).
    """
    upto = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    held = rows.withColumns(values)
    running = held.withColumns({f"run_{v}": F.sum(v).over(upto) for v in values})
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = held.groupBy("part").agg(*[F.sum(v).alias(f"sum_{v}") for v in values]).select(
        "part", *[F.coalesce(F.sum(f"sum_{v}").over(before), F.lit(0)).alias(f"shift_{v}") for v in values]
    )
    running = settle(
        running.join(F.broadcast(shifts), "part").withColumns({f"run_{v}": F.col(f"run_{v}") + F.col(f"shift_{v}") for v in values})
        .drop(*[f"shift_{v}" for v in values]),
        "running",
    )
    heads = settle(
        running.where("number = head").select(
            F.col("head").alias("of"), *[(F.col(f"run_{v}") - F.col(v)).alias(f"head_{v}") for v in values]
        ),
        "heads",
    )
    return (
        running.join(heads, F.col("head") == F.col("of"))
        .withColumns({f"run_{v}": F.col(f"run_{v}") - F.col(f"head_{v}") for v in values})
        .drop("of", *[f"head_{v}" for v in values])
    )


def _sorted_turns(talks: DataFrame, order: list[Column]) -> DataFrame:
    """All turns with number, part, place, and head and depth in their conversation."""
    sorted_rows = settle(
        talks.orderBy(*order)
        .withColumn("id", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("id", 33).cast("int"))
        .withColumn("place", F.col("id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("id"),
        "turns",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sorted_rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    )
    rows = settle(
        sorted_rows.join(F.broadcast(shifts), "part").withColumn("number", F.col("shift") + F.col("place")).drop("shift"),
        "numbered",
    )
    heads = settle(rows.groupBy("conv_id").agg(F.min("number").alias("head")), "heads").withColumnRenamed("conv_id", "of")
    return settle(
        rows.join(heads, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of").withColumn("depth", F.col("number") - F.col("head")),
        "placed",
    )


def format_conversations(
    talks: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    vocabulary: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The emitted nodes, and the turns of each conversation with their nodes.

    Nodes: tree (the node it begins with), node, depth, learned (its role is
    ``assistant``), ids, body_from and body_to (where the text's ids lie among
    them; for learned nodes that is the loss mask), n_tokens, emit_start (place of
    its first token in the emission), position_start (tokens before it on its own
    path: the first token's position id), attended_until (end of the interval of
    places that may attend to it; it begins at emit_start).
    Turns: conv_id, depth (the turn's number from 0), node.

    Turns of a conversation go by turn, role and text; repeated rows are turns of
    their own. Null roles and texts are empty; null turns come first; rows with a
    null conv_id are one conversation. An empty table gives two empty ones. Other
    columns are not read.
    """
    spark = talks.sparkSession
    ranks = spark.sparkContext.broadcast(read_vocabulary(vocabulary or vocabulary_path(VOCABULARY)))
    plain = talks.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = _sorted_turns(plain, [F.col(c) for c in ("conv_id", "turn", "role", "text")])
    marks = {
        f"hash_{i}": F.xxhash64("depth", "role", "text", F.lit(i)).cast("decimal(20,0)") for i in (1, 2)
    }
    thin = rows.select("number", "head", "depth", "part", "place", "role", "text").withColumns(marks).drop("role", "text")
    key = ["depth", "run_hash_1", "run_hash_2"]
    summed = settle(_along(thin, {m: F.col(m) for m in marks}).drop(*marks), "paths")
    nodes = settle(
        summed.groupBy(*key).agg(F.min("number").alias("node"), F.count(F.lit(1)).alias("held_by")), "nodes"
    )
    steps = settle(
        summed.join(nodes, key).select("number", "head", "depth", "part", "place", "node", "held_by"), "steps"
    )
    content = rows.join(steps.where("number = node").select("number"), "number").select(
        F.col("number").alias("node"), "depth", (F.col("role") == LEARNED).alias("learned"),
        escaped(F.col("role")).alias("role"), escaped(F.col("text")).alias("text"),
    )
    written = settle(
        content.mapInArrow(
            _encoded(ranks),
            "node long, depth long, learned boolean, ids array<int>, body_from long, body_to long, n_tokens long",
        ),
        "written",
    )
    lengths = steps.join(written.select("node", "n_tokens"), "node")
    spots = settle(_along(settle(lengths, "lengths"), {"n_tokens": F.col("n_tokens")}), "spots")
    spots = spots.withColumn("position_start", F.col("run_n_tokens") - F.col("n_tokens"))

    # Leaves from left to right, by the nodes at which they part from others. The row
    # before a node's first one is a row of its parent.
    parents = steps.select((F.col("number") + 1).alias("node"), F.col("held_by").alias("parent_held_by"))
    parting = (F.col("depth") == 0) | (F.col("held_by") < F.col("parent_held_by"))
    partings = settle(nodes.join(parents, "node", "left").where(parting).select("node"), "partings")
    paths = (
        steps.join(partings, "node")
        .groupBy("head")
        .agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("nodes"))
        .select(F.col("head").alias("leaf"), F.transform("nodes", lambda x: x["node"]).alias("path"))
    )
    leaves = numbered(paths, [F.col("path"), F.col("leaf")], "rank").select("leaf", "rank")
    leaves = settle(leaves, "leaves")
    ranked = settle(spots.join(leaves, F.col("head") == F.col("leaf")), "ranked")
    spans = settle(
        ranked.groupBy("node").agg(
            F.min("rank").alias("first_leaf"), F.max("rank").alias("last_leaf"),
            F.max("position_start").alias("position_start"), F.max("n_tokens").alias("n_tokens"),
        ),
        "spans",
    )
    # What each leaf emits: the nodes that no leaf before it holds, a chain that ends with it.
    emitted = spans.groupBy("first_leaf").agg(F.sum("n_tokens").alias("tokens"), F.min("position_start").alias("from"))
    emitted = leaves.join(emitted, F.col("rank") == F.col("first_leaf"), "left").select(
        "rank", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("from", F.lit(0)).alias("from")
    )
    places = settle(numbered(emitted, [F.col("rank")], "again", total="tokens").drop("again"), "places")
    starts = places.select(F.col("rank").alias("first_leaf"), F.col("tokens_before").alias("begins"), "from")
    stops = places.select(F.col("rank").alias("last_leaf"), (F.col("tokens_before") + F.col("tokens")).alias("attended_until"))
    roots = steps.where("depth = 0").select(F.col("head").alias("of"), F.col("node").alias("tree"))
    trees = steps.where("number = node").select("node", "head").join(roots, F.col("head") == F.col("of")).select("node", "tree")
    out = (
        spans.join(starts, "first_leaf")
        .join(stops, "last_leaf")
        .select("node", "position_start", (F.col("begins") + F.col("position_start") - F.col("from")).alias("emit_start"), "attended_until")
        .join(written, "node")
        .join(trees, "node")
        .select("tree", "node", "depth", "learned", "ids", "body_from", "body_to", "n_tokens", "emit_start", "position_start", "attended_until")
    )
    turns = rows.select("conv_id", "depth", "number").join(steps.select("number", "node"), "number").drop("number")
    return out, turns


def _read(ranks, id_type: pa.DataType):
    """Turns sorted by conversation and depth -> a row per conversation, read from the ids."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _encoding(ranks.value).decode_bytes
        known, state = None, None
        for batch in slices(batches):
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "ids", "body_from", "body_to", "learned")]
            for conv, ids, start, end, learned in zip(*columns):
                if known is None or known[0] != conv:
                    if known:
                        done.append(_digest(known[0], state))
                    known, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                head, body, tail = (decode(x).decode() for x in (ids[:start], ids[start:end], ids[end:]))
                text = unescaped(body)
                role = unescaped(head[len(OPEN) : -len(BODY)])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if learned:
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(head) + len(body) + len(tail)
                state[5] += len(ids)
            yield _rows(done)
        yield _rows([_digest(known[0], state)] if known else [])

    def _digest(conv, s: list) -> tuple:
        return conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4], s[5]

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        columns = list(zip(*done)) if done else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return task


def read_back(nodes: DataFrame, turns: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Each conversation as it is read from the emitted ids.

    conv_id, n_turns, turns_sha256 (of role, newline, text, newline per turn),
    loss_chars and loss_sha256 (the text under the loss mask, unescaped),
    formatted_chars and n_tokens of the conversation as it would stand alone. A
    conversation's rows pass one task as a stream; nothing but digests is kept.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    ranks = nodes.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary or vocabulary_path(VOCABULARY)))
    kind = turns.schema["conv_id"].dataType
    return (
        turns.join(nodes.select("node", "ids", "body_from", "body_to", "learned"), "node")
        .select("conv_id", "depth", "ids", "body_from", "body_to", "learned")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "depth")
        .mapInArrow(
            _read(ranks, to_arrow_type(kind)),
            f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
            "formatted_chars long, n_tokens long",
        )
    )
