"""Boilerplate lines against counting by hand."""

import re
from collections import Counter

from pyspark.sql import functions as F

from shopgrain.llm.line_dedup import HTML_LINES, drop_boilerplate, host
from tests.llm.tools import documents, rows_of


def brute(rows, ratio=0.5, least=5):
    pages = Counter(r[3] for r in rows)
    held = Counter()
    for r in rows:
        for line in {x.strip(" ") for x in re.split(r"\r\n|\r|\n", r[1] or "")} - {""}:
            held[r[3], line] += 1
    bad = {k for k, n in held.items() if pages[k[0]] >= least and n > ratio * pages[k[0]]}
    out = []
    for r in rows:
        lines = re.split(r"\r\n|\r|\n", r[1] or "")
        left = [x for x in lines if (r[3], x.strip(" ")) not in bad]
        full = sum(x.strip(" ") != "" for x in lines)
        text = r[1] if len(left) == len(lines) else "\n".join(left)
        out.append((r[0], full, len(lines) - len(left), text))
    return sorted(out, key=repr)


def test_lines_of_sites(spark):
    rows = [(n, f"Menu\n  own {n}\n\nFooter", "en", "a") for n in range(10)]
    rows += [(100 + n, "Menu\nFooter" if n < 5 else f"Menu\r\nbody {n}\r\n", "en", "b") for n in range(10)]
    rows += [(200 + n, "Menu\nMenu", "en", "small") for n in range(4)]
    rows += [(300 + n, "Menu\nx", None, None) for n in range(6)]
    rows += [(400, None, "en", "a"), (401, "", "en", "a"), (402, "long " * 50_000 + "\nMenu", "en", "a")]
    rows += [(7, "Menu\nMenu\nnot of a", "en", "b"), (500, "Menu\nrepeated", "en", "a"), (500, "Menu\nrepeated", "en", "a")]
    got = drop_boilerplate(documents(spark, rows, clash=True), "source", "text")
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_text") == brute(rows)
    assert {"line", "site", "hash", "id"} <= set(got.columns)
    assert {r.id for r in got.collect()} == {"x"}


def test_a_ratio_is_exceeded_not_reached(spark):
    rows = [(n, f"half {n % 2}\n{n}", "en", "a") for n in range(10)]
    assert rows_of(drop_boilerplate(documents(spark, rows), "source", "text"), "n_dropped") == [(0,)] * 10


def test_hosts(spark):
    urls = ["http://WWW.a.org/x?y=//b", "https://u:p@b.org:8080/", "ftp://c", "no url", None, "http://d.org?x"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(host(F.col("url"))).collect()] == ["www.a.org", "b.org", "c", "", None, "d.org"]


def test_html(spark):
    pages = spark.createDataFrame([(n, f"<p>Menu</p>\n<b>{n}</b>") for n in range(6)], "page_id int, html string")
    got = drop_boilerplate(pages, F.lit("h"), "html", HTML_LINES)
    assert rows_of(got, "page_id", "n_lines", "n_dropped", "kept_text")[2] == (2, 2, 1, "\n2\n")


def test_empty_table(spark):
    assert drop_boilerplate(documents(spark, []), "source", "text").collect() == []


def test_columns_named_like_hidden_ones_stay(spark):
    rows = [(n, f"Menu\nown {n}", "en", "a") for n in range(6)]
    plain = documents(spark, rows)
    names = ["__bl_of", "__bl_bad", "__bl_lines", "__bl_kept", "__bl_same", "__bl_site", "__BL_text", "__bl__of", "n_lines"]
    clash = plain.withColumns({c: F.lit(f"own {c}") for c in names})
    got = drop_boilerplate(clash, "source", "text")
    want = drop_boilerplate(plain, "source", "text")
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_text") == rows_of(want, "doc_id", "n_lines", "n_dropped", "kept_text")
    assert set(got.columns) == {*want.columns, *names}
    for c in names[:-1]:
        assert {r[0] for r in got.select(c).collect()} == {f"own {c}"}
