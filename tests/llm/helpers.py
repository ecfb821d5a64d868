"""Small inputs with the cases that every operator must bear."""

from __future__ import annotations

import os

FOLDER = "/root/testdata/sf0.01"
ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, row bigint, bucket int, k int, leaf string, stat_chars int"


def odd_rows(extra=()):
    """Nulls in every column, empty and very long texts, ties and repeated rows, columns whose names operators might use."""
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000)) + "\n" + "a" * 200_000
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", "en", None, 4), (4, long_text, "en", "b", 1), (5, "one two three four five six", "en", "b", 2),
            (6, "one two three four five six", "en", "b", 2), (6, "one two three four five six", "en", "b", 2), (6, "other words with the same id", "en", "b", 2), (None, "no id at all here", None, "c", 3), *extra]
    return [(*r, "x", 7, None, 3, "y", None) for r in rows]


def odd_docs(spark, extra=()):
    return spark.createDataFrame(odd_rows(extra), ODD)


def documents(spark, where="true"):
    return spark.read.parquet(os.path.join(FOLDER, "documents.parquet")).where(where)


def texts_of(df):
    return {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}
