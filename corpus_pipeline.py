"""From raw documents to packed training sequences, one written table after another."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.llm.language import identify
from shopgrain.llm.line_dedup import drop_boilerplate
from shopgrain.llm.mixing import mix_sources
from shopgrain.llm.near_dedup import near_duplicates
from shopgrain.llm.packing import pack
from shopgrain.sources.scratch import settle, shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents of this similarity or more, in percent, are one to the near_dedup stage.
NEAR_SHARE = 80
#: A source's line is boilerplate above this share of its different texts, from 20 texts on.
COMMON_LINE = 0.05


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null and letterless texts and doubtful ones go.

    Whole texts are judged, however long. Repeated rows are judged alike and all stay
    or all go; null ids stay; an empty table gives no rows; other columns are dropped.
    """
    found = identify(docs, keep=COLUMNS)
    return found.where("NOT rejected").select(*COLUMNS)


def site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that their source repeats; n_chars follows the text.

    A null source is a source like any other. Null texts stay null, an empty text stays
    empty, and a text all of whose lines go is empty. Rows that repeat stay, each
    without the same lines; null ids stay; an empty table gives no rows; other columns
    are dropped.
    """
    freed = drop_boilerplate(docs.select(*COLUMNS), "source", "text", common=COMMON_LINE)
    changed = F.col("n_dropped") > 0
    return freed.withColumns(
        {
            "text": F.col("kept_text"),
            "n_chars": F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")),
        }
    ).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id.

    Of rows that share that doc_id, one row with the smallest hash of the text stays.
    """
    found = near_duplicates(docs, share=NEAR_SHARE)
    own = F.col("component").isNull()  # an empty set is its document's own
    heads = settle(
        found.where("kept")
        .groupBy(
            "component",
            F.when(own, F.col("doc_id")).alias("own_doc"),
            F.when(own, F.col("text_hash")).alias("own_text"),
        )
        .agg(
            F.min("doc_id").alias("of_doc"), F.min("text_hash").alias("of_text"), F.count(F.lit(1)).alias("rows")
        ),
        "heads",
    )
    return _once(docs.select(*COLUMNS), heads.select("of_doc", "of_text", "rows")).select(*COLUMNS)


def _once(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row for each (of_doc, of_text) of ``chosen``, with its other columns; ``rows`` tells how many there are."""
    rows = docs.withColumn("__hash", F.xxhash64("text")).join(
        chosen, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("__hash") == F.col("of_text"))
    )
    repeated = rows.where("rows > 1").dropDuplicates(["doc_id", "__hash"])
    return rows.where("rows = 1").unionByName(repeated)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Documents without words have no size and are taken like others, up to twice, which
    adds nothing to the mix. Rows that repeat are documents of their own, which together give as many rows as the mix takes of them.
    A null id is an id and a null source a source like any other; an empty table gives
    no rows; other columns are dropped.
    """
    key = ["doc_id", "source", "text_hash"]
    copies = settle(
        mix_sources(docs).groupBy(*key).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")), "copies"
    ).where("copies > 0")
    chosen = copies.select(
        F.col("doc_id").alias("of_doc"), F.col("source").alias("of_source"), F.col("text_hash").alias("of_text"), "copies", "rows"
    )
    rows = docs.select(*COLUMNS).withColumn("__hash", F.xxhash64("text")).join(
        chosen,
        F.col("doc_id").eqNullSafe(F.col("of_doc"))
        & F.col("source").eqNullSafe(F.col("of_source"))
        & (F.col("__hash") == F.col("of_text")),
    )
    once = rows.where("rows = 1").unionByName(rows.where("rows > 1").dropDuplicates(["doc_id", "source", "__hash"]))
    return once.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences.

    A null or empty text is one piece of the end id; a text longer than a window is cut
    into full ones and a rest. Rows that repeat are documents of their own, null ids
    stay null, an empty table gives no rows.
    """
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("line_dedup", site_lines),
    ("near_dedup", one_of_each_group),
    ("mixing", mixed),
    ("packing", packed),
]

#: A trained model, sketches and pivotal sampling have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
