from __future__ import annotations

import random

from helpers import documents, fully, odd_rows, prose, words

from feedloom.llm import lines
from pyspark.sql import functions as F


def brute(texts, min_words):
    """Delete lines in any run that occurs earlier, by comparing all pairs of places."""
    split = [(t or "").split("\n") for t in texts]
    seq = [[(n, x.strip(" \t\n\x0b\x0c\r"), len(words(x))) for n, x in enumerate(s) if words(x)] for s in split]
    places = [(d, p) for d, s in enumerate(seq) for p in range(len(s))]
    gone = [set() for _ in texts]
    for d, p in places:
        for e, q in places:
            if (e, q) >= (d, p):
                break
            n = 0
            while p + n < len(seq[d]) and q + n < len(seq[e]) and seq[d][p + n][1] == seq[e][q + n][1]:
                n += 1
            if n and sum(x[2] for x in seq[d][p : p + n]) >= min_words:
                gone[d].update(x[0] for x in seq[d][p : p + n])
    # lines without words between two that go
    for d, s in enumerate(seq):
        for a, b in zip(s, s[1:]):
            if a[0] in gone[d] and b[0] in gone[d]:
                gone[d].update(range(a[0], b[0]))
    return [
        t if not g else "\n".join(x for n, x in enumerate(s) if n not in g)
        for t, s, g in zip(texts, split, gone)
    ]


def test_runs_match_all_pairs_of_places(spark):
    dice = random.Random(4)
    pool = [prose(i, dice.choice([1, 2, 3, 7, 20])) for i in range(14)] + ["", "  "]
    for min_words in (5, 12):
        texts = ["\n".join(dice.choice(pool) for _ in range(dice.randint(0, 25))) for _ in range(12)]
        found = lines.without_repeats(documents(spark, texts), min_words=min_words)
        assert [r.text for r in found.orderBy("doc_id").collect()] == brute(texts, min_words)


def test_a_run_that_repeats_itself(spark):
    texts = ["\n".join(["same four words here"] * 40), "\n".join(["same four words here"] * 3)]
    found = lines.without_repeats(documents(spark, texts), min_words=8)
    assert [r.text for r in found.orderBy("doc_id").collect()] == brute(texts, 8)


def test_long_passages_go_and_short_ones_stay(spark):
    passage, short = prose(1, 60), prose(2, 20)
    texts = [f"{prose(9, 30)}\n{passage}\n{short}", f"{short}\n{prose(8, 30)}\n  {passage}", passage]
    found = [r.text for r in lines.without_repeats(documents(spark, texts)).orderBy("doc_id").collect()]
    assert found[0] == texts[0]
    assert passage not in found[1] and short in found[1]
    assert found[2] == ""


def test_spans_are_disjoint_and_name_their_document(spark):
    texts = [prose(1, 60) + "\n" + prose(2, 60), prose(3, 5) + "\n" + prose(1, 60) + "\n\n" + prose(2, 60)]
    runs = fully(lines.repeated_runs(documents(spark, texts)))
    assert [(r["d"], r["first_line"], r["last_line"]) for r in runs] == [(1, 1, 3)]


def test_odd_rows_and_empty_tables(spark):
    docs = odd_rows(spark).withColumn("d", F.lit(1)).withColumn("k", F.lit(2)).withColumn("spans", F.lit(3))
    found = lines.without_repeats(docs, min_words=1)
    assert found.columns == [*docs.columns, "removed_lines"]
    rows = fully(found)
    assert len(rows) == docs.count()
    assert sum(r["text"] is None for r in rows) == 2
    # rows of equal id and text are one document: neither is a later copy
    assert [r["removed_lines"] for r in rows if r["doc_id"] == 4] == [0, 0]
    assert lines.without_repeats(docs.limit(0)).count() == 0
