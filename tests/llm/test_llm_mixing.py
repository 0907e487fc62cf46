from __future__ import annotations

import random

import pytest
from helpers import documents, fully, odd_rows, prose, words

from feedloom.llm import mixing
from pyspark.sql import functions as F


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Reshare the excess by weight until no target is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        each = left / sum(weight[s] for s in free)
        over = {s for s in free if each * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: each * weight[s] for s in free}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("seed", range(3))
def test_targets(spark, seed):
    dice = random.Random(seed)
    sizes = {f"s{i}": dice.choice([0, 5, 100, 10_000, dice.randint(1, 500)]) for i in range(17)} | {None: 40}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(df).collect()}
    expected = brute_targets(sizes)
    assert found.keys() == expected.keys()
    assert all(found[s] == pytest.approx(expected[s]) for s in found)


def test_words_taken_come_near_the_targets(spark):
    dice = random.Random(1)
    texts = [prose(i, dice.choice([0, 1, 10, 10, 10, 50, 200])) for i in range(900)]
    docs = documents(spark, texts, ["a", "b", "a", "c", "d", "a"])
    rows = fully(mixing.mixed(docs))
    assert rows and all(r["size"] == len(words(r["text"])) for r in rows)
    for source in "abcd":
        own = [r for r in rows if r["source"] == source]
        taken = sum(r["copies"] * r["size"] for r in own)
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        assert abs(taken - own[0]["target"]) <= 400
        ratio = own[0]["target"] / own[0]["source_size"]
        assert {r["copies"] for r in own} <= {int(ratio), int(ratio) + 1} and max(r["copies"] for r in own) <= 2
    again = fully(mixing.mixed(docs.repartition(7)))
    assert {(r["doc_id"], r["copies"]) for r in again} == {(r["doc_id"], r["copies"]) for r in rows}


def test_each_copy_is_emitted_once(spark):
    docs = documents(spark, [prose(i, 20) for i in range(60)], ["a", "b", "c"]).withColumn("copy", F.lit("x"))
    drawn = {r["doc_id"]: r["copies"] for r in fully(mixing.mixed(docs))}
    out = fully(mixing.emitted(docs))
    assert len(out) == sum(drawn.values())
    assert {r["doc_id"] for r in out} == {d for d, n in drawn.items() if n}
    assert {r["copy"] for r in out} == {"x"} and {r["_copy"] for r in out} == {1, 2}


def test_odd_rows_and_empty_tables(spark):
    docs = odd_rows(spark).withColumn("size", F.lit("clash"))
    for name in ("c_source", "mix", "mix_hash", "mix_in_source", "s", "z", "t", "n", "source_size"):
        docs = docs.withColumn(name, F.lit("clash"))
    rows = fully(mixing.mixed(docs))
    assert len(rows) == docs.count()
    assert {(r["c_source"], r["mix_hash"], r["mix_in_source"], r["n"]) for r in rows} == {("clash",) * 4}
    assert all(r["size"] == len(words(r["text"])) for r in rows)
    assert {r["target"] for r in rows if r["source"] is None} == {0.0}
    assert mixing.mixed(docs.limit(0)).count() == mixing.emitted(docs.limit(0)).count() == 0
