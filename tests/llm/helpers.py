"""Brute-force versions and odd tables for the tests of this folder."""

import re

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Nulls in every column, empty and blank texts, repeated rows and ids, a long text, and columns named like results.
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_words string, size string, fp string, row string, kept string, score string, n_lines string"
ODD_ROWS = [
    (1, "one two three four five six seven eight nine ten " * 3, "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, " \n\t ", "de", "b"),
    (5, "x" * 3000, "fr", None), (6, "same text here", "en", "b"), (6, "same text here", "en", "b"), (6, "other text of the same id", "en", "b"),
    (None, "no id at all", "en", "c"), (None, None, "en", "c"), (7, "word " * 30_000, "es", "a"), (8, "line\nline\n\nline", "es", "a"),
    (9, "é\u00a0\U0001f600 one\x0btwo\x0cthree", "es", "d"),
]


def odd_table(spark):
    return spark.createDataFrame([(*r, *["own"] * 7) for r in ODD_ROWS], ODD_SCHEMA)


def rows_of(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
