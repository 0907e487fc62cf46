"""Small fixtures and brute-force versions for the tests of the text operators."""

from __future__ import annotations

import random

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def documents(spark, texts, sources=None):
    """Documents with ids 0, 1, ... for the given texts."""
    rows = [
        (i, t, "en", (sources or ["a"])[i % len(sources or ["a"])], None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n, vocabulary=4000):
    dice = random.Random(seed)
    return " ".join(f"w{dice.randrange(vocabulary)}" for _ in range(n))


def odd_rows(spark):
    """Nulls in every column, empty and long texts, repeated rows."""
    long = prose(1, 30_000)
    rows = [
        (None, None, None, None, None),
        (None, "a null id", None, "a", 9),
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", None, 4),
        (4, long, "en", "b", len(long)),
        (4, long, "en", "b", len(long)),
        (5, "x", "fr", "b", 1),
        (5, "y", "fr", "b", 1),
        (6, "\U0001f600 tie tie", "fr", "b", 9),
    ]
    return spark.createDataFrame(rows, DOCS)


def fully(df):
    return [r.asDict(recursive=True) for r in df.collect()]
