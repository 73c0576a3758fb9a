"""Small fixtures for the operators' tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names clash with each other and with names used inside.
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, Text string, key long, node long, block long, digests string, `DOC_ID` string"


def docs(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(spark, rows):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        return spark.createDataFrame([(r[0], r[1], "en", "s", 0, "other", 1, 2, 3, "x", "y") for r in rows], CLASHING)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def words(rnd: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rnd.randrange(vocabulary):03d}" for _ in range(n)]


def tuples(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
