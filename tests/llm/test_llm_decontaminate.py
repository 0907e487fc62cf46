from __future__ import annotations

import random

import pytest
from helpers import documents, fully, odd_rows, prose

from feedloom.llm import decontaminate
from pyspark.sql import functions as F


def brute_tiles(a, b, least):
    """Longest common unmarked stretch over all pairs of places, again and again."""
    used_a, used_b, out = [False] * len(a), [x is None for x in b], []
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not used_a[i + k] and not used_b[j + k]:
                    k += 1
                if k >= least and (best is None or k > best[2]):
                    best = (i, j, k)
        if best is None:
            return out
        i, j, k = best
        used_a[i : i + k] = used_b[j : j + k] = [True] * k
        out.append(best)


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_tiles_match_a_search_of_all_places(least):
    dice = random.Random(least)
    for _ in range(150):
        a = [dice.choice("abc") for _ in range(dice.randint(0, 25))]
        b = [None if dice.random() < 0.1 else dice.choice("abc") for _ in range(dice.randint(0, 35))]
        assert decontaminate.tiles(a, b, least) == brute_tiles(a, b, least)


def items_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def brute_leaks(texts, items, least=5, coverage=0.5):
    found = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            a, b = decontaminate.tokens(item), decontaminate.tokens(text)
            covered = sum(k for _, _, k in brute_tiles(a, b, min(least, len(a)))) if a else 0
            if a and covered / len(a) >= coverage:
                found[d, i] = covered
    return found


def test_leaks_match_tiling_of_all_pairs(spark):
    dice = random.Random(2)
    items = [prose(i, 40, 300) for i in range(8)] + ["too short here", items_tail := prose(50, 6, 300)]
    texts = []
    for i, item in enumerate(items):
        w = item.split()
        third = len(w) // 3
        reordered = " ".join(w[2 * third :] + ["x"] + w[:third] + ["y"] + w[third : 2 * third])
        texts += [
            f"{prose(90 + i, 30)} {item.upper()}. {prose(70 + i, 10)}",
            f"{prose(60 + i, 20)} {reordered} end",
            " ".join(w[: len(w) // 2 - 3]) + " " + prose(40 + i, 30),
        ]
    texts += [prose(i, 200, 300) for i in range(6)] + [items_tail, None, ""]
    dice.shuffle(texts)
    found = fully(decontaminate.leaks(documents(spark, texts), items_of(spark, items)))
    assert {(r["doc_id"], r["item_id"]): r["covered_tokens"] for r in found} == brute_leaks(texts, items)
    # a filter of a few slots lets too much through, which the join drops
    narrow = decontaminate.leaks(documents(spark, texts), items_of(spark, items), filter_bits=2)
    assert len(fully(narrow)) == len(found)


def test_short_items_and_scripts_without_spaces(spark):
    items = ["Paris is big", "one", "two words", "a b c d", "北京是中国的首都。", "東京", "ไทยแลนด์", "", "?!", "x y x y"]
    texts = [
        "they say PARIS, is big!", "paris was big", "just one of two word", "two words", "a b c e d a b c d",
        "他说北京是中国的首都吗", "北京 是 中国", "東 京", "東の京", "สวัสดีไทยแลนด์", "x y x", "x y x y x y", None, "", "?!",
        "a b c", prose(1, 80),
    ]
    found = fully(decontaminate.leaks(documents(spark, texts), items_of(spark, items)))
    known = {(r["doc_id"], r["item_id"]): r["covered_tokens"] for r in found}
    assert known == brute_leaks(texts, items)
    assert {(0, 0), (2, 1), (3, 2), (4, 3), (5, 4), (7, 5), (9, 6), (11, 9)} <= set(known)


@pytest.mark.parametrize("seed", range(3))
def test_leaks_of_dense_texts_match_tiling_of_all_pairs(spark, seed):
    dice = random.Random(seed)
    items = [" ".join(dice.choice("abc") for _ in range(dice.randint(1, 14))) for _ in range(12)]
    texts = [" ".join(dice.choice("abcd") for _ in range(dice.randint(0, 60))) for _ in range(25)]
    found = fully(decontaminate.leaks(documents(spark, texts), items_of(spark, items)))
    assert {(r["doc_id"], r["item_id"]): r["covered_tokens"] for r in found} == brute_leaks(texts, items)


def test_what_stays(spark):
    item = prose(1, 30)
    docs = documents(spark, [prose(2, 50), f"a {item} b", None, "", item.lower()])
    kept = decontaminate.without_leaks(docs, items_of(spark, [item]))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]


def test_odd_rows_and_empty_tables(spark):
    docs = odd_rows(spark).withColumn("text_key", F.lit(1)).withColumn("item", F.lit("clash"))
    long = prose(1, 30_000)
    items = spark.createDataFrame(
        [(1, " ".join(long.split()[100:140])), (1, None), (None, ""), (2, "a null id x y z")],
        "item_id long, text string",
    )
    found = fully(decontaminate.leaks(docs, items))
    # repeated rows are one document
    assert [(r["doc_id"], r["item_id"], r["coverage"]) for r in found] == [(4, 1, 1.0)]
    assert decontaminate.without_leaks(docs, items).count() == docs.count() - 2
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0
    assert decontaminate.without_leaks(docs, items.limit(0)).count() == docs.count()
    assert decontaminate.leaks(docs.limit(0), items).count() == 0
