"""Documents whose sets of word n-grams are alike, by a join on groups of equal prefixes.

The tokens (hashed n-grams) of all sets have one order, rare ones first. Two sets of
at least the wanted similarity share a token among the first few of each, their
prefixes. The order needs the frequency of tokens only where prefixes lie: by hash
the first eighth of all tokens is counted, and a bounded sieve tells which of them
are frequent, in four classes. It decides speed alone; any order gives all links.

1. Equal sets are one class; classes of equal size and prefix are one group.
2. Groups are listed under the tokens of their prefixes. Group pairs under a token are
   filtered by their sizes and by the tokens' places in both prefixes.
3. Under tokens with long lists every group is first compared with a few others, the
   leaders of the list; what is linked by that is one component, and only pairs of
   different components remain.
4. The pairs left are expanded to their members, filtered by the bits in which the
   sets' parity sketches differ (a bound of their difference), and verified on full
   sets. All links between components are found, so the components are right.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.arrow import lists, slices, small_batches, text_bytes
from shopgrain.llm.graph import components
from shopgrain.llm.sieve import sieved
from shopgrain.llm.text import mix, shingles, word_hashes
from shopgrain.sources.scratch import settle

WORDS, SHARE = 3, 90
#: Tokens below this hash are counted.
COUNTED = 1 << 61
#: A token is in the class of the number of bars that its count exceeds.
BARS = (4, 32, 256, 2048)
#: The sieve has this many places of four bits: 8 MB, however many tokens there are.
PLACES = 1 << 24
#: Lists with more groups are first compared with so many of their own.
LONG_LIST, LEADERS = 32, 32
#: Words of 64 bits in a parity sketch, and in its brief form.
SKETCH, BRIEF = 16, 4


# -- sets --------------------------------------------------------------------


def _signature(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _halves(signs: list[bytes]) -> list[pa.Array]:
    pair = np.frombuffer(b"".join(signs), np.int64).reshape(-1, 2)
    return [pa.array(np.ascontiguousarray(pair[:, i])) for i in (0, 1)]


def _measured(words: int):
    """doc_id, text -> doc_id, n_shingles, sig_a, sig_b, counted: the set's tokens below COUNTED, once for equal sets of a batch."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, signs, low, seen = np.zeros(batch.num_rows, np.int64), [], [], set()
            for row, found in word_hashes(text_bytes(batch.column("text"))):
                values = shingles(found, words)
                sizes[row] = len(values)
                signs.append(_signature(values))
                low.append(values[: 0 if signs[-1] in seen else np.searchsorted(values, np.uint64(COUNTED))])
                seen.add(signs[-1])
            flat = np.concatenate(low).view(np.int64) if low else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes),
                    *_halves(signs),
                    lists(flat, np.fromiter(map(len, low), np.int64, len(low)), pa.int64()),
                ],
                ["doc_id", "n_shingles", "sig_a", "sig_b", "counted"],
            )

    return task


def prefix_length(size, share: int):
    """How many first tokens hold one in common with every set of the wanted similarity."""
    return size - (share * size + 99) // 100 + 1


class Sieve:
    """The class of a token: 0 if it is rare or unknown, up to four. Tokens that share a place share the higher class."""

    def __init__(self, words: np.ndarray, bits: np.ndarray):
        self.table = np.zeros(PLACES // 16, np.uint64)
        self.table[words] = bits

    def classes(self, tokens: np.ndarray) -> np.ndarray:
        place = mix(tokens) % np.uint64(PLACES)
        bits = self.table[(place >> np.uint64(4)).astype(np.int64)] >> ((place & np.uint64(15)) << np.uint64(2))
        return np.bitwise_count(bits & np.uint64(15))

    def ordered(self, tokens: np.ndarray) -> np.ndarray:
        """Tokens (sorted by hash) with the rare ones first."""
        return tokens[np.argsort(self.classes(tokens), kind="stable")]


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """token, class -> word, bits of the sieve."""
    for batch in batches:
        place = mix(batch.column("token").to_numpy().view(np.uint64)) % np.uint64(PLACES)
        ones = (np.uint64(1) << batch.column("class").to_numpy().astype(np.uint64)) - np.uint64(1)
        bits = ones << ((place & np.uint64(15)) << np.uint64(2))
        yield pa.RecordBatch.from_arrays(
            [pa.array((place >> np.uint64(4)).view(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"]
        )


def _sieve(marks: DataFrame) -> Sieve:
    """The frequencies of tokens as a sieve: what reaches the driver has a fixed size."""
    rank = sum((F.col("count") > bar).cast("int") for bar in BARS)
    frequent = (
        marks.select(F.explode("counted").alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > BARS[0])
        .select("token", rank.alias("class"))
    )
    rows = (
        frequent.mapInArrow(_places, "word long, bits long")
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    return Sieve(rows.column("word").to_numpy(), rows.column("bits").to_numpy().view(np.uint64))


def parity(tokens: np.ndarray) -> np.ndarray:
    """Bits that tell of how many tokens there is an odd number: sets that differ in d tokens differ in d bits at most."""
    place = mix(tokens ^ np.uint64(0x5851F42D4C957F2D))
    bits = np.zeros(SKETCH, np.uint64)
    np.bitwise_xor.at(
        bits, (place % np.uint64(SKETCH)).astype(np.int64), np.uint64(1) << ((place >> np.uint64(32)) % np.uint64(64))
    )
    return bits


def _prefixed(words: int, share: int, shared):
    """doc_id, text -> doc_id, sig_a, sig_b, prefix, prefix_a, prefix_b, sketch; texts without words go."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = shared.value
        for batch in slices(batches):
            full, signs, prefixes, marks, sketches = np.zeros(batch.num_rows, bool), [], [], [], []
            for row, found in word_hashes(text_bytes(batch.column("text"))):
                values = shingles(found, words)
                if not len(values):
                    continue
                full[row] = True
                prefix = sieve.ordered(values)[: prefix_length(len(values), share)]
                signs.append(_signature(values))
                marks.append(_signature(prefix))
                prefixes.append(prefix)
                sketches.append(parity(values))
            if not full.any():
                continue
            flat = np.concatenate(prefixes).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").filter(pa.array(full)),
                    *_halves(signs),
                    lists(flat, np.fromiter(map(len, prefixes), np.int64, len(prefixes)), pa.int64()),
                    *_halves(marks),
                    lists(np.concatenate(sketches).view(np.int64), np.full(len(sketches), SKETCH), pa.int64()),
                ],
                ["doc_id", "sig_a", "sig_b", "prefix", "prefix_a", "prefix_b", "sketch"],
            )

    return task


def _of_heads(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows (doc_id, sig_a, sig_b, ..) of each class's smallest document, with class, size, repeats."""
    heads = classes.select(
        F.col("sig_a").alias("of_a"), F.col("sig_b").alias("of_b"), F.col("doc_id").alias("of_doc"), "class", "size", "repeats"
    )
    same = (
        (F.col("sig_a") == F.col("of_a"))
        & (F.col("sig_b") == F.col("of_b"))
        & F.col("doc_id").eqNullSafe(F.col("of_doc"))
    )
    return rows.join(heads, same).drop("of_a", "of_b", "of_doc")


def _once(rows: DataFrame) -> DataFrame:
    """One row a class. Only the rows of classes whose smallest document is repeated are shuffled."""
    if rows.where("repeats > 1").isEmpty():
        return rows.drop("repeats")
    repeated = rows.where("repeats > 1").dropDuplicates(["class"])
    return settle(rows.where("repeats = 1").unionByName(repeated).drop("repeats"), "once")


# -- filters -----------------------------------------------------------------


def _brief(sketch: str) -> Column:
    """A parity sketch with fewer bits: each is the parity of some bits of the whole one."""

    def folded(i: int) -> Column:
        out = F.col(sketch)[i]
        for k in range(i + BRIEF, SKETCH, BRIEF):
            out = out.bitwiseXOR(F.col(sketch)[k])
        return out

    return F.array(*[folded(i) for i in range(BRIEF)])


def _may_link(share: int, a_size: str, a_place: str, b_size: str, b_place: str) -> list[Column]:
    """The size filter, and the place filter: what two sets can share from their first common token on."""
    small, large = F.least(a_size, b_size), F.greatest(a_size, b_size)
    rest = F.least(F.col(a_size) - F.col(a_place), F.col(b_size) - F.col(b_place))
    return [
        100 * small >= share * large,
        (100 + share) * rest >= share * (F.col(a_size) + F.col(b_size)),
    ]


def _sketches_allow(share: int, words: int = SKETCH) -> Column:
    """Linked sets differ in at most (100 - share) / (100 + share) of both sizes."""
    apart = sum(
        F.bit_count(F.col("a_sketch")[i].bitwiseXOR(F.col("b_sketch")[i])).cast("long") for i in range(words)
    )
    return (100 + share) * apart <= (100 - share) * (F.col("a_size") + F.col("b_size"))


def _checked(share: int):
    """a, b, a_set, b_set -> the linked a, b."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            keep = np.zeros(batch.num_rows, bool)
            left, right = batch.column("a_set"), batch.column("b_set")
            for row in range(batch.num_rows):
                a = np.frombuffer(left[row].as_buffer(), np.uint64)
                b = np.frombuffer(right[row].as_buffer(), np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep[row] = 100 * common >= share * (len(a) + len(b) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return task


def _sets(words: int):
    """class, repeats, sig_a, sig_b, text -> class, repeats, set; rows whose text is not that of the class are left out."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(found, words) for _, found in word_hashes(text_bytes(batch.column("text")))]
            pair = np.frombuffer(b"".join(map(_signature, sets)), np.int64).reshape(len(sets), 2)
            same = (pair[:, 0] == batch.column("sig_a").to_numpy()) & (pair[:, 1] == batch.column("sig_b").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), batch.column("repeats"), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["class", "repeats", "set"],
            ).filter(pa.array(same))

    return task


class Verifier:
    """Confirms pairs on full sets, which are built for the classes of these pairs only."""

    def __init__(self, wanted: DataFrame, classes: DataFrame, share: int, words: int):
        self.wanted, self.share, self.words = wanted, share, words
        self.heads = classes.select("class", "repeats", F.col("doc_id").alias("of_doc"), "sig_a", "sig_b")

    def _sets_of(self, pairs: DataFrame) -> DataFrame:
        concerned = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        heads = settle(self.heads.join(concerned, "class"), "heads")
        texts = sieved(self.wanted, heads.select(F.col("of_doc").alias("doc_id")), "doc_id").join(
            heads, F.col("doc_id").eqNullSafe(F.col("of_doc"))
        )
        found = texts.select("class", "repeats", "sig_a", "sig_b", "text").mapInArrow(
            _sets(self.words), "class long, repeats long, set binary"
        )
        return _once(settle(found, "sets"))

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Those of the settled ``pairs`` (a, b: classes) that are linked."""
        with small_batches(pairs.sparkSession):
            sets = self._sets_of(pairs)
            both = pairs.join(sets.toDF("a", "a_set"), "a").join(sets.toDF("b", "b_set"), "b")
            checked = both.select("a", "b", "a_set", "b_set").mapInArrow(_checked(self.share), "a long, b long")
            return settle(checked, "links")


# -- the join ----------------------------------------------------------------


def similar_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE, words: int = WORDS
) -> DataFrame:
    """One row per document: doc_id, n_shingles (size of its set), component_id.

    Words are runs of characters other than 0x20 and 0x09-0x0D, A-Z as a-z; a
    document's set holds its distinct runs of ``words`` words, or the whole as one
    if it has fewer. Two documents are linked when 100 * intersection >= ``share``
    * union; ``component_id`` is the smallest doc_id that links lead to, itself
    included. Sets are compared by 64-bit hashes of their runs.

    Null and empty texts have an empty set, are linked with nothing and are their
    own component. Null doc_ids count as larger than any other; a component of them
    alone has the id null. Repeated rows are documents of their own. An empty table
    gives no rows. Other columns of ``docs`` are not read.
    """
    if not 0 < share <= 100:
        raise ValueError("share is a percentage above 0")
    wanted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = wanted.schema["doc_id"].dataType.simpleString()
    with small_batches(docs.sparkSession):
        marks = settle(
            wanted.mapInArrow(
                _measured(words), f"doc_id {kind}, n_shingles long, sig_a long, sig_b long, counted array<long>"
            ),
            "measured",
        )
    each = marks.where("n_shingles > 0").groupBy("sig_a", "sig_b", "doc_id")
    classes = settle(
        each.agg(F.count(F.lit(1)).alias("rows"), F.max("n_shingles").alias("size"))
        .groupBy("sig_a", "sig_b")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.max("size").alias("size"),
            # of the smallest document; unknown if it is null
            F.coalesce(F.min_by("rows", "doc_id"), F.lit(2).cast("long")).alias("repeats"),
        )
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    reached = _linked_classes(wanted, marks, classes, share, words)
    named = settle(
        classes.join(reached, "class", "left").withColumn("component", F.coalesce("component", "class")), "named"
    )
    smallest = settle(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "smallest")
    decided = settle(named.join(smallest, "component").select("sig_a", "sig_b", "component", "component_id"), "decided")
    found = marks.drop("counted").join(decided, ["sig_a", "sig_b"], "left")
    own = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", own.alias("component_id"))


def _linked_classes(wanted: DataFrame, marks: DataFrame, classes: DataFrame, share: int, words: int) -> DataFrame:
    """class, component of every class that is linked with another."""
    spark, kind = wanted.sparkSession, wanted.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(_sieve(marks))
    with small_batches(spark):
        cut = wanted.mapInArrow(
            _prefixed(words, share, shared),
            f"doc_id {kind}, sig_a long, sig_b long, prefix array<long>, prefix_a long, prefix_b long, sketch array<long>",
        )
        prefixes = _once(settle(_of_heads(cut, classes).drop("doc_id", "sig_a", "sig_b"), "prefixes"))
    groups = settle(
        prefixes.groupBy("size", "prefix_a", "prefix_b").agg(F.min("class").alias("group"), F.count(F.lit(1)).alias("members")),
        "groups",
    )
    # A group bears the number of its first class, which also brings the prefix.
    listed = prefixes.join(groups.select(F.col("group").alias("class")), "class").select(
        F.col("class").alias("group"), "size", F.posexplode("prefix").alias("place", "token")
    )
    common = settle(
        listed.groupBy("token").agg(F.count(F.lit(1)).alias("length")).where("length > 1"), "tokens"
    )
    lists_ = settle(listed.join(common, "token"), "lists")
    members = prefixes.join(groups, ["size", "prefix_a", "prefix_b"]).select("group", "class", "size", "sketch", "members")
    concerned = lists_.select("group").distinct()
    members = settle(
        members.join(concerned.withColumn("listed", F.lit(True)), "group", "left")
        .where("members > 1 OR listed")
        .select("group", "class", "size", "sketch"),
        "members",
    )
    verifier = Verifier(wanted, classes, share, words)
    known = _by_leaders(lists_, members, verifier)
    last = verifier.linked(_all_pairs(lists_, members, known, share))
    links = last if known is None else known.select(F.col("class").alias("a"), F.col("component").alias("b")).union(last)
    return components(links).toDF("class", "component")


def _components_of(links: DataFrame) -> DataFrame:
    return settle(components(links), "known").toDF("class", "component")


def _with_component(members: DataFrame, known: DataFrame | None) -> DataFrame:
    if known is None:
        return members.withColumn("component", F.col("class"))
    return members.join(known, "class", "left").withColumn("component", F.coalesce("component", "class"))


def _main_components(rows: DataFrame) -> DataFrame:
    """token, main, n, kinds: the component most frequent under a token, how often it is, and how many there are."""
    per = rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("token").agg(
        F.max_by("component", "n").alias("main"), F.max("n").alias("n"), F.count(F.lit(1)).alias("kinds")
    )


def _by_leaders(lists_: DataFrame, members: DataFrame, verifier: Verifier) -> DataFrame | None:
    """class, component after two passes: members against the first of their group, then long lists against leaders.

    After the first pass a group falls into parts, one for each component of its
    members, that one member stands for. Every long list has LEADERS of its parts as
    leaders, and a part is compared with the leaders of its lists that are not of its
    own component. None if nothing was linked.
    """
    share = verifier.share
    inside = members.where(F.col("class") != F.col("group")).select(F.col("class").alias("a"), F.col("group").alias("b"))
    links = verifier.linked(settle(inside, "pairs"))
    known = None if links.isEmpty() else _components_of(links)
    long_lists = lists_.where(F.col("length") > LONG_LIST)
    if long_lists.isEmpty():
        return known
    parts = _with_component(members, known).groupBy("group", "component").agg(
        F.min("class").alias("part"), F.min_by("sketch", "class").alias("sketch")
    )
    here = settle(long_lists.join(parts, "group").drop("length", "group"), "long_lists")
    # Leaders could pass the place filter. One hash for all lists makes them the same ones wherever lists overlap.
    able = (100 + share) * (F.col("size") - F.col("place")) >= 2 * share * F.col("size")
    by_chance = [F.min_by("part", F.xxhash64(F.lit(i), "part")) for i in range(LEADERS)]
    named = (
        here.where(able)
        .groupBy("token")
        .agg(F.array_distinct(F.array(*by_chance)).alias("leaders"))
        .select("token", F.explode("leaders").alias("b"))
    )

    def side(name: str) -> DataFrame:
        own = [F.col(c).alias(f"{name}_{c}") for c in ("size", "place", "component", "sketch")]
        return here.select("token", F.col("part").alias(name), *own)

    met = side("a").join(side("b").join(named, ["token", "b"]), "token").where("a_component <> b_component")
    for bar in _may_link(share, "a_size", "a_place", "b_size", "b_place"):
        met = met.where(bar)
    met = met.where(_sketches_allow(share))
    pairs = settle(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    both = settle(links.union(verifier.linked(pairs)), "links")
    return None if both.isEmpty() else _components_of(both)


def _all_pairs(lists_: DataFrame, members: DataFrame, known: DataFrame | None, share: int) -> DataFrame:
    """a, b: all pairs of classes of different components that the filters leave, once."""
    states = settle(_with_component(members, known), "states")
    # A group falls into the parts that belong to one component each, named by their first class.
    # A part of one class has its sketch, in brief.
    brief = [F.when(F.count(F.lit(1)) == 1, F.max(_brief("sketch")[i])).alias(f"s{i}") for i in range(BRIEF)]
    parts = settle(
        states.groupBy("group", "component").agg(
            F.min("class").alias("part"), F.max("size").alias("size"), F.count(F.lit(1)).alias("n"), *brief
        ),
        "parts",
    )
    rows = lists_.select("token", "group", "place").join(parts, "group")
    # Under a token the largest component need not be paired with itself: only pairs with others are made.
    main = settle(_main_components(rows).where("kinds > 1").select("token", "main"), "main")
    rows = settle(rows.join(main, "token"), "rows")

    def side(df: DataFrame, name: str) -> DataFrame:
        sketch = F.array(*[f"s{i}" for i in range(BRIEF)]).alias(f"{name}_sketch")
        own = [c for c in ("group", "place", "component", "part", "size", "n", "main") if c in df.columns]
        kept = ["token"] if "token" in df.columns else []
        return df.select(*kept, *[F.col(c).alias(f"{name}_{c}") for c in own], sketch)

    def allowed(pairs: DataFrame) -> DataFrame:
        """Each part with its number of classes, the one with fewer classes first."""
        near = pairs.where("a_component <> b_component").where(F.coalesce(_sketches_allow(share, BRIEF), F.lit(True)))
        fewer = (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a_part") < F.col("b_part")))
        a, b = F.col("a_part"), F.col("b_part")
        return near.select(F.when(fewer, a).otherwise(b).alias("few"), F.when(fewer, b).otherwise(a).alias("many"))

    across = side(rows.where("component <> main"), "a").join(side(rows, "b"), "token")
    across = across.where("a_group <> b_group AND (b_component = b_main OR a_part < b_part)")
    for bar in _may_link(share, "a_size", "a_place", "b_size", "b_place"):
        across = across.where(bar)
    inside = side(parts, "a").join(side(parts, "b"), (F.col("a_group") == F.col("b_group")) & (F.col("a_part") < F.col("b_part")))
    of_parts = settle(allowed(across).distinct().unionByName(allowed(inside)), "part_pairs")
    held = settle(
        states.join(parts.select("group", "component", "part"), ["group", "component"]).select(
            "part", "class", "size", "sketch"
        ),
        "held",
    )
    first, second = (
        held.select(F.col("part").alias(end), *[F.col(c).alias(f"{n}_{c}") for c in ("class", "size", "sketch")])
        for end, n in (("few", "a"), ("many", "b"))
    )
    met = of_parts.join(first, "few").join(second, "many").where(_sketches_allow(share))
    return settle(met.select(F.col("a_class").alias("a"), F.col("b_class").alias("b")), "pairs")
