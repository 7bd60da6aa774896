"""The registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.llm import (
    chat,
    exact_dedup,
    jaccard_join,
    language,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    pii,
    resampling,
    spelling,
    token_counts,
    topk,
)
from shopgrain.sources.scratch import settle


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one made of control strings, read back from the emitted nodes."""
    talks = _table(spark, folder, "conversations")
    trap = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    nodes, turns = chat.format_conversations(talks.select("conv_id", "turn", "role", "text").unionByName(trap))
    back = chat.read_back(settle(nodes, "nodes"), turns)
    return back.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op2_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(_table(spark, folder, "documents"))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, folder, "documents"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(_table(spark, folder, "documents"))


def op7_top_inner_products(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_inner_products(_table(spark, folder, "embeddings"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, folder, "documents"))


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All pages; the digest is that of the text that stays."""
    pages = line_dedup.drop_boilerplate(
        _table(spark, folder, "pages"), line_dedup.host(F.col("url")), "html", line_dedup.HTML_LINES
    )
    return pages.select(
        "page_id",
        line_dedup.host(F.col("url")).alias("host"),
        "n_lines",
        "n_dropped",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dedup.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.similar_documents(_table(spark, folder, "documents"))


def op12_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resampling.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """The words of all documents, some of them misspelt by rule."""
    groups = spelling.spelling_variants(_table(spark, folder, "documents"), dropping=31)
    return groups.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_format,
        op2_personal_data,
        op3_exact_dedup,
        op4_packing,
        op5_mixing,
        op6_language,
        op7_top_inner_products,
        op8_token_counts,
        op9_line_dedup,
        op10_near_dedup,
        op11_jaccard_join,
        op12_resampling,
        op13_spelling,
    )
}

#: CRC-32 of a text's UTF-8 by its table, whose 256 entries are made by rule.
_CRC = """RECURSIVE crc_steps(i, k, c) AS (
    SELECT i, 0, i FROM range(256) t(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_steps WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS entries FROM crc_steps WHERE k = 8)"""


def _crc_of(column: str) -> str:
    digits = f"hex(encode({column}))"
    octets = f"list_transform(range(1, length({digits}), 2), lambda i: CAST('0x' || substr({digits}, CAST(i AS INTEGER), 2) AS BIGINT))"
    step = "lambda c, b: xor(c >> 8, entries[CAST(xor(c & 255, b) + 1 AS INTEGER)])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), {step}), 4294967295)"


_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op1_chat_format": r"""
WITH talks AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
    UNION ALL
    SELECT -7, v.turn, v.role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)
), written AS (
    SELECT *,
           length(role) + length(body) + 13
           + length(regexp_replace(role || body, '[^\\<\[]', '', 'g')) AS chars
    FROM talks
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn, role, body)) AS turns_sha256,
       CAST(coalesce(sum(length(body)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(body, '' ORDER BY turn, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id
""",
    "op7_top_inner_products": """
WITH points AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS point
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.point, c.point), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM points q JOIN points c ON q.vec_id <> c.vec_id AND len(q.point) = len(c.point)
    WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 20
""",
    "op3_exact_dedup": f"""
WITH texts AS (
    SELECT doc_id, {_AZ.format("coalesce(text, '')")} AS body FROM documents
), groups AS (
    SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY body
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.body) AS text_sha256
FROM texts t JOIN groups g USING (body)
""",
    "op9_line_dedup": r"""
WITH hosts AS (
    SELECT page_id, html,
           lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1)) AS host
    FROM pages
), numbered AS (
    SELECT *, row_number() OVER () AS page,
           string_split_regex(coalesce(html, ''), '(?:<[^>]*>|[\r\n])+') AS lines
    FROM hosts
), spots AS (
    SELECT page, host, unnest(lines) AS raw, generate_subscripts(lines, 1) AS spot FROM numbered
), held AS (
    SELECT host, trim(raw) AS line, count(DISTINCT page) AS pages
    FROM spots WHERE trim(raw) <> '' GROUP BY host, line
), sites AS (
    SELECT host, count(*) AS site_pages FROM hosts GROUP BY host
), bad AS (
    SELECT host, line FROM held JOIN sites USING (host)
    WHERE site_pages >= 5 AND pages > 0.5 * site_pages
), counted AS (
    SELECT s.page,
           count(*) FILTER (trim(raw) <> '') AS n_lines,
           count(b.line) AS n_dropped,
           string_agg(raw, chr(10) ORDER BY spot) FILTER (b.line IS NULL) AS kept_text
    FROM spots s LEFT JOIN bad b ON b.host = s.host AND b.line = trim(s.raw)
    GROUP BY s.page
)
SELECT n.page_id, n.host, c.n_lines, c.n_dropped,
       sha256(CASE WHEN n.html IS NULL THEN NULL WHEN c.n_dropped = 0 THEN n.html
                   ELSE coalesce(c.kept_text, '') END) AS kept_sha256
FROM numbered n JOIN counted c USING (page)
""",
    "op11_jaccard_join": f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(string_split_regex({_AZ.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))) END AS shingles
    FROM worded
), spread AS (
    SELECT doc_id, len(shingles) AS size, unnest(shingles) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM spread a JOIN spread b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
        AND 100 * least(a.size, b.size) >= 90 * greatest(a.size, b.size)
    GROUP BY a.doc_id, b.doc_id, a.size, b.size
    HAVING 100 * count(*) >= 90 * (a.size + b.size - count(*))
), steps AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, s.b FROM reached r JOIN steps s ON r.other = s.a
)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, r.component_id
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r USING (doc_id)
""",
    "op12_resampling": f"""
WITH {_CRC}, texts AS (
    SELECT doc_id, {_AZ.format("coalesce(text, '')")} AS body FROM documents
), words AS (
    SELECT doc_id, unnest(regexp_extract_all(body, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM texts
), aimed AS (
    SELECT unnest(regexp_extract_all({_AZ.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark
), held AS (
    SELECT doc_id, word, count(*) AS times FROM words GROUP BY ALL
), places AS (
    SELECT word, {_crc_of("word")} % 10000 AS bucket
    FROM (SELECT word FROM held UNION SELECT word FROM aimed), crc_table
), source AS (
    SELECT bucket, CAST(sum(times) AS BIGINT) AS s FROM held JOIN places USING (word) GROUP BY bucket
), target AS (
    SELECT bucket, count(*) AS t FROM aimed JOIN places USING (word) GROUP BY bucket
), totals AS (
    SELECT (SELECT CAST(coalesce(sum(s), 0) AS BIGINT) FROM source) AS all_s, (SELECT CAST(coalesce(sum(t), 0) AS BIGINT) FROM target) AS all_t
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE))) AS BIGINT) AS gain
    FROM source LEFT JOIN target USING (bucket), totals
), weights AS (
    SELECT doc_id, CAST(sum(times) AS BIGINT) AS n_features, CAST(sum(times * gain) AS BIGINT) AS weight
    FROM held JOIN places USING (word) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
    SELECT t.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || t.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
               / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM texts t LEFT JOIN weights USING (doc_id)
), ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS able FROM scored WHERE n_features >= 20
)
SELECT s.*, CASE WHEN r.rank <= 10 * able // 100 THEN r.rank END AS rank FROM scored s LEFT JOIN ranked r USING (doc_id)
""",
    "op13_spelling": f"""
WITH {_CRC}, runs AS (
    SELECT doc_id, unnest(regexp_extract_all({_AZ.format("coalesce(text, '')")}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents
), held AS (
    SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
    SELECT run, times, {_crc_of("doc_id || ':' || run")} AS h FROM held, crc_table
), spelt AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
        ELSE run END AS word, times
    FROM hashed
), words AS (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
), cuts AS (
    SELECT DISTINCT word, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
    FROM (SELECT word, unnest(CAST(range(1, length(word) + 1) AS INTEGER[])) AS place FROM words)
), pairs AS (
    SELECT DISTINCT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
    UNION SELECT c.word, w.word FROM cuts c JOIN words w ON c.rest = w.word
    UNION SELECT w.word, c.word FROM cuts c JOIN words w ON c.rest = w.word
), best AS (
    SELECT p.a AS word, count(*) AS n_near, arg_min(p.b, (-b.n, p.b)) AS near, max(b.n) AS near_n
    FROM pairs p JOIN words b ON p.b = b.word GROUP BY p.a
), formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form,
           CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
    FROM words w LEFT JOIN best USING (word)
), led AS (
    SELECT word, word AS spot, 0 AS step FROM formed
    UNION ALL
    SELECT l.word, f.form, l.step + 1 FROM led l JOIN formed f ON l.spot = f.word WHERE f.form IS NOT NULL
), roots AS (
    SELECT word, arg_max(spot, step) AS root FROM led GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
""",
}
