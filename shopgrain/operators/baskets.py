"""What orders contain. No order's lines are gathered before the orders are chosen.

Lines are counted per order and product in the map tasks first; lists are built
only for the orders (or baskets) that a report shows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.operators.rollups import order_product_sums
from shopgrain.sources.retail import Retail
from shopgrain.sources.scratch import settle


def _copies(t: Retail) -> DataFrame:
    return order_product_sums(t).select("order_id", "product_id", F.col("lines").alias("copies"))


def order_products(t: Retail) -> DataFrame:
    """Order, product, copies: lines of known products, spread by order."""
    lines = _copies(t)
    named = lines.join(t.products.select("product_id", "product_name", "category"), "product_id")
    return t.spread(named, "order_id")


def of_known_orders(t: Retail, per_order: DataFrame) -> DataFrame:
    """Only now are orders that the table lacks left out: one narrow row each, instead of their lines."""
    return per_order.join(t.spread(t.order_heads.select("order_id"), "order_id"), "order_id", "left_semi")


def order_sizes(t: Retail) -> DataFrame:
    """Lines and different products of each known order."""
    return t.once(
        "order_sizes",
        lambda: of_known_orders(
            t,
            order_products(t)
            .groupBy("order_id")
            .agg(F.sum("copies").alias("product_count"), F.count(F.lit(1)).alias("different")),
        ),
    )


def _repeated(entries: Column, field: str) -> Column:
    return F.flatten(
        F.transform(entries, lambda e: F.array_repeat(e[field], e["copies"].cast("int")))
    )


def basket_lists(t: Retail, chosen: DataFrame) -> DataFrame:
    """Aligned product and category lists, sorted by name, of the few ``chosen`` orders.

    ``chosen`` is a settled table of a report's rows, so Spark knows its size and
    filters the sales against it where they are scanned, as long as it is small.
    """
    entries = (
        t.sales.join(chosen.select("order_id"), "order_id", "left_semi")
        .groupBy("order_id", "product_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .join(t.products.select("product_id", "product_name", "category"), "product_id")
        .groupBy("order_id", "product_name", "category")
        .agg(F.sum("copies").alias("copies"))
        .groupBy("order_id")
        .agg(F.sort_array(F.collect_list(F.struct("product_name", "category", "copies"))).alias("e"))
    )
    return entries.select(
        "order_id",
        _repeated(F.col("e"), "product_name").alias("products"),
        _repeated(F.col("e"), "category").alias("categories"),
    )


def basket_marks(per_product: DataFrame) -> DataFrame:
    """One row per order: 128 bits that are equal for equal baskets, and its line count.

    The marks are order-free sums over the basket's entries, so they are combined
    in the map tasks and an order of any length stays one narrow row. Two different
    baskets share both marks with a chance below 1e-16 even among 1e11 orders.
    """
    entry = per_product.groupBy("order_id", "product_name", "category").agg(
        F.sum("copies").alias("copies")
    )
    parts = ["product_name", "category", "copies"]
    return entry.groupBy("order_id").agg(
        F.bit_xor(F.xxhash64(F.lit(1), *parts)).alias("mark_a"),
        F.bit_xor(F.xxhash64(F.lit(2), *parts)).alias("mark_b"),
        F.sum("copies").alias("lines"),
    )


# -- pairs bought together ---------------------------------------------------

#: Products of an order that meet in one join key; wider orders are cut into parts.
PART = 64
#: Items whose pairs tell from what count on a pair can be among the best; no result depends on it.
CHIEFS = 64


def _item_entries(t: Retail) -> DataFrame:
    """Order, product, item, copies, and how many products the order holds.

    Products of one name and category are one item, named by its lowest product.
    """
    names = t.products.select("product_id", "product_name", "category")
    items = names.groupBy("product_name", "category").agg(F.min("product_id").alias("item"))
    product_items = names.join(items, ["product_name", "category"]).select("product_id", "item")
    lines = _copies(t)
    # Both settled: the entries are made once, and a join of two tables may split a wide order.
    entries = settle(lines.join(product_items, "product_id"), "entries")
    sizes = settle(entries.groupBy("order_id").agg(F.count(F.lit(1)).alias("different")), "sizes")
    return entries.join(sizes.where(F.col("different") > 1), "order_id")


def _side(entries: DataFrame, side: str, *more: str) -> DataFrame:
    return entries.select(
        "order_id",
        *more,
        *[F.col(c).alias(f"{c}_{side}") for c in ("product_id", "item", "copies")],
    )


def _pair_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("item_a", "item_b").agg(
        F.sum(F.col("copies_a") * F.col("copies_b")).alias("n")
    )


def _pairs_within(entries: DataFrame) -> DataFrame:
    """How many line pairs of one order each item pair has.

    The products of an order are cut into parts of about ``PART``, and each pair of
    parts is a join key of its own, so an order of any width is paired by many
    tasks; a row is copied once for each part.
    """
    cut = F.ceil(F.col("different") / F.lit(PART)).cast("int")
    part = F.pmod(F.xxhash64("product_id"), cut).cast("int")
    every = F.explode(F.sequence(F.lit(0), cut - 1))
    a = _side(entries.withColumn("part_a", part).withColumn("part_b", every), "a", "part_a", "part_b")
    b = _side(entries.withColumn("part_b", part).withColumn("part_a", every), "b", "part_a", "part_b")
    return _pair_counts(
        a.join(b, ["order_id", "part_a", "part_b"]).where(F.col("product_id_a") < F.col("product_id_b"))
    )


def _possible_counts(entries: DataFrame) -> DataFrame:
    """The most line pairs that any pair with an item can have: item, bound.

    With c(o, i) copies of item i in order o, a pair has at most the sum over o of
    c(o, a) * c(o, b). Two bounds follow, and the lower one is taken: c(o, b) is at
    most the order's largest count; and the sum is at most the product of the items'
    norms (Cauchy-Schwarz), of which the largest norm bounds the partner's.
    """
    held = entries.groupBy("order_id", "item").agg(F.sum("copies").alias("copies"))
    most = held.groupBy("order_id").agg(F.max("copies").alias("most"))
    bounds = settle(
        held.join(most, "order_id")
        .groupBy("item")
        .agg(
            F.sum(F.col("copies") * F.col("most")).cast("double").alias("by_order"),
            F.sqrt(F.sum(F.col("copies").cast("double") * F.col("copies"))).alias("norm"),
        ),
        "bounds",
    )
    largest = bounds.agg(F.max("norm")).first()[0]
    # A little is added so that rounding never makes a bound too low.
    by_norm = F.col("norm") * F.lit(largest) * F.lit(1 + 1e-9) + 1
    return bounds.select("item", F.least(F.col("by_order"), by_norm).alias("bound"))


def top_pairs(t: Retail, n: int = 30) -> DataFrame:
    """The ``n`` item pairs that most line pairs of one order hold: item_a, item_b, n.

    The pairs of the items with the highest bounds are counted first; the n-th of
    them has a count that every pair among the best reaches. Items whose bound is
    below it are left out, the others are paired. The rule is a bound, so the result
    is exact.
    """
    entries = settle(_item_entries(t), "entries")
    best = [F.desc("n"), F.col("item_a"), F.col("item_b")]
    bounds = settle(_possible_counts(entries), "possible")
    chiefs = settle(bounds.orderBy(F.desc("bound"), "item").limit(CHIEFS).select("item"), "chiefs")
    among_chiefs = _pairs_within(entries.join(F.broadcast(chiefs), "item", "left_semi"))
    leaders = among_chiefs.orderBy(F.desc("n")).select("n").take(n)  # at most n numbers
    least = leaders[-1]["n"] if len(leaders) == n else 1
    live = bounds.where(F.col("bound") >= least).select("item")
    return _pairs_within(entries.join(live, "item", "left_semi")).orderBy(*best).limit(n)
