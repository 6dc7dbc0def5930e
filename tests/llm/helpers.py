"""Rows that every operator must stand: nulls, empty, blank and long texts, repeated rows, clashing columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string"


def edge_rows():
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta"]
    long = " ".join(rng.choice(words) for _ in range(60_000))
    rows = [
        (1, None, None, None, None, None, None), (2, "", "en", "a", 0, 0.5, "x"), (3, " \t\n", "en", "b", 3, None, None), (4, "one", "en", "a", 3, 1.0, "y"),
        (5, long, "en", "b", len(long), None, None), (6, "ünïcödé 日本語 🙂 text", "de", None, 20, None, None), (None, "no id here at all", None, "c", 5, None, None),
    ]
    return rows + [(7, "the same row twice over", "en", "a", 9, None, None)] * 2


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)
