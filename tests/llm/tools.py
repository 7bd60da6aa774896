"""Rows of the documents' form for small tests."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, *, clash=False):
    """rows: (doc_id, text[, lang[, source]]); ``clash`` adds columns named like the operators' own."""
    full = [(*r, *(None,) * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS).repartition(3)
    if clash:
        for name in ("class", "row", "hash", "line", "site", "kept", "component", "unit", "piece", "name", "text_hash", "id"):
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
