"""Lines that a site repeats: dropped by their frequency relative to the site's pages.

For each site the pages that contain a line are divided by the site's pages;
lines above ``max_ratio`` are boilerplate and leave every page of that site. A
page counts once for a line, however often it holds it. Counts are combined
before the shuffle, so a line on a third of all pages is one row per map task.

A site has few boilerplate lines: each is on more than ``max_ratio`` of its pages,
so there are at most 1 / ``max_ratio`` times as many as a page has lines on
average. They are one row per site, and the pages meet them by site.

Large sites, such as the sources of a corpus, repeat lines on a small share of
their pages. For them there is a second, lower bar, ``common``: a line above that
share goes if it is also on ``common_pages`` pages or more. There copies of a text
count once, or a page that was copied often would lose its own lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.sources.scratch import settle

MAX_RATIO = 0.5
MIN_PAGES = 5
COMMON_PAGES = 20
TEXT_LINES = r"\r\n|\r|\n"
HTML_LINES = r"(?:<[^>]*>|[\r\n])+"


def host(url: Column) -> Column:
    """The lower-cased host of a URL, without user and port; '' if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1))


def _lines(text: Column, pattern: str) -> Column:
    return F.split(F.coalesce(text, F.lit("")), pattern, -1)


def boilerplate(
    pages: DataFrame, site: Column, text: Column, pattern: str, max_ratio: float, min_pages: int
) -> DataFrame:
    """site, line, pages, site_pages of the lines that exceed the ratio."""
    rows = pages.select(site.alias("site"), text.alias("text"))
    totals = rows.groupBy("site").agg(F.count(F.lit(1)).alias("site_pages")).where(F.col("site_pages") >= min_pages)
    held = (
        rows.select("site", F.explode(F.array_distinct(F.transform(_lines(F.col("text"), pattern), F.trim))).alias("line"))
        .where("line <> ''")
        .groupBy("site", "line")
        .agg(F.count(F.lit(1)).alias("pages"))
        .where(F.col("pages") > max_ratio * min_pages)  # no site is smaller
    )
    held, totals = settle(held, "lines"), settle(totals, "sites").withColumnRenamed("site", "of")
    return held.join(totals, F.col("site").eqNullSafe(F.col("of"))).where(F.col("pages") > max_ratio * F.col("site_pages")).drop("of")


def common_lines(
    pages: DataFrame, site: Column, text: Column, pattern: str, max_ratio: float, min_pages: int, common: float, common_pages: int
) -> DataFrame:
    """site, line, pages, site_pages of the lines above either bar; all counts are of different texts.

    Rows are counted first, as in ``boilerplate``: no line has more texts than rows.
    Only the lines that pass by their rows are counted again by texts, with a site's
    lines in one row.
    """
    rows = pages.select(site.alias("site"), text.alias("text"), F.xxhash64(text).alias("hash"))
    totals = settle(
        rows.select("site", "hash").distinct().groupBy("site").agg(F.count(F.lit(1)).alias("site_pages")), "sites"
    ).withColumnRenamed("site", "of")
    most = F.col("pages") > max_ratio * F.col("site_pages")
    many = (F.col("pages") > common * F.col("site_pages")) & (F.col("pages") >= common_pages)
    above = (F.col("site_pages") >= min_pages) & (most | many)
    lines = F.array_distinct(F.transform(_lines(F.col("text"), pattern), F.trim))
    held = settle(
        rows.select("site", F.explode(lines).alias("line"))
        .where("line <> ''")
        .groupBy("site", "line")
        .agg(F.count(F.lit(1)).alias("pages"))
        .where(F.col("pages") > min(max_ratio * min_pages, common_pages - 1)),
        "lines",
    )
    maybe = settle(
        held.join(totals, F.col("site").eqNullSafe(F.col("of")))
        .where(above)
        .groupBy(F.col("site").alias("of"))
        .agg(F.collect_set("line").alias("maybe")),
        "maybe",
    )
    texts = (
        rows.join(maybe, F.col("site").eqNullSafe(F.col("of")))
        .select("site", "hash", F.explode(F.array_intersect(lines, F.col("maybe"))).alias("line"))
        .distinct()
        .groupBy("site", "line")
        .agg(F.count(F.lit(1)).alias("pages"))
    )
    return texts.join(totals, F.col("site").eqNullSafe(F.col("of"))).where(above).drop("of")


def _free_prefix(columns: list[str]) -> str:
    """A prefix that no column begins with, in capital or small letters."""
    prefix = "__bl_"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def drop_boilerplate(
    pages: DataFrame,
    site: Column | str = "site",
    text: str = "text",
    pattern: str = TEXT_LINES,
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    joiner: str = "\n",
    common: float | None = None,
    common_pages: int = COMMON_PAGES,
) -> DataFrame:
    """``pages`` with the text freed of its site's boilerplate lines; every row stays.

    ``pattern`` separates lines; they are compared without the spaces around
    them, and blank ones never count. Sites of fewer than ``min_pages`` pages
    keep all lines, since there a ratio says nothing. With ``common``, lines above
    that ratio go too if ``common_pages`` pages or more hold them, and all ratios are
    of different texts instead of rows. A page from which no line
    goes keeps its text as it is; else the lines that stay, blank ones included,
    are joined with ``joiner``.

    Added columns: n_lines (that are not blank), n_dropped, and kept_text, with a
    null text left null. Null sites are one site of their own. Repeated rows are
    pages of their own. Ids play no part, so null and repeated ones do no harm. An
    empty table stays empty. All columns stay; one of the three names, if it is
    there already, is replaced; whatever the others are called, no name of this function's own meets them.
    """
    site = F.col(site) if isinstance(site, str) else site
    own = _free_prefix(pages.columns)
    hidden = {f"{own}site": site, f"{own}text": F.col(text)}
    rows = pages.withColumns(hidden)
    bars = (rows, F.col(f"{own}site"), F.col(f"{own}text"), pattern, max_ratio, min_pages)
    bad = boilerplate(*bars) if common is None else common_lines(*bars, common, common_pages)
    by_site = settle(
        bad.groupBy(F.col("site").alias(f"{own}of")).agg(F.collect_set("line").alias(f"{own}bad")), "boilerplate"
    )
    out = rows.join(by_site, F.col(f"{own}site").eqNullSafe(F.col(f"{own}of")), "left")
    lines = F.col(f"{own}lines")
    out = out.withColumn(f"{own}lines", _lines(F.col(f"{own}text"), pattern)).withColumn(
        f"{own}kept",
        F.when(F.col(f"{own}bad").isNull(), lines).otherwise(
            F.filter(lines, lambda x: ~F.array_contains(F.col(f"{own}bad"), F.trim(x)))
        ),
    ).withColumn(f"{own}same", F.size(f"{own}kept") == F.size(lines))

    def full(a: Column) -> Column:
        return F.size(F.filter(a, lambda x: F.trim(x) != "")).cast("long")

    same = F.col(f"{own}same")
    return out.withColumns(
        {
            "n_lines": full(lines),
            "n_dropped": F.when(same, F.lit(0).cast("long")).otherwise((F.size(lines) - F.size(f"{own}kept")).cast("long")),
            "kept_text": F.when(same, F.col(f"{own}text")).otherwise(F.array_join(f"{own}kept", joiner)),
        }
    ).drop(*hidden, f"{own}lines", f"{own}kept", f"{own}same", f"{own}of", f"{own}bad")
