from __future__ import annotations

import random

import pytest
import xxhash
from helpers import LOWER, documents, fully, odd_rows, prose, words

from feedloom.llm import graph, simhash
from pyspark.sql import functions as F


def brute_print(text, shingle=4):
    w = words((text or "").translate(LOWER))
    if not w:
        return 0
    votes = [
        xxhash.xxh64_intdigest(" ".join(w[i : i + shingle]).encode(), 42)
        for i in range(max(1, len(w) - shingle + 1))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))


def brute_components(keys, linked):
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in keys:
        for b in keys:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def unsigned(n):
    return n % (1 << 64)


def test_fingerprints_match_a_plain_version(spark):
    texts = [None, "", "One", "one two three", "A b C d", "a b c d e", "Été  x y z", prose(3, 700)]
    found = simhash.with_fingerprint(documents(spark, texts).select("doc_id", "text"))
    assert {r.doc_id: unsigned(r.fingerprint) for r in found.collect()} == {
        i: brute_print(t) for i, t in enumerate(texts)
    }


@pytest.mark.parametrize("distance", [1, 3, 4])
def test_links_of_fingerprints_match_all_pairs(spark, distance):
    dice = random.Random(distance)
    prints = {0, (1 << 64) - 1}
    for _ in range(25):
        seed = dice.getrandbits(64)
        prints.add(seed)
        for _ in range(8):
            for _ in range(dice.randint(1, 4)):
                seed ^= 1 << dice.randrange(64)
            prints.add(seed)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = simhash.linked(spark.createDataFrame(signed, "fingerprint long"), distance)
    expected = brute_components(sorted(p for (p,) in signed), lambda a, b: (a ^ b if (a < 0) == (b < 0) else unsigned(a) ^ unsigned(b)).bit_count() <= distance)
    assert {r.fingerprint: r.root for r in found.collect()} == expected


def test_a_group_of_near_copies_makes_no_square_of_rows(spark):
    """All values within two bits of one: 2081 fingerprints, two million linked pairs."""
    near = {0} | {1 << a for a in range(63)} | {1 << a | 1 << b for a in range(63) for b in range(a)}
    prints = spark.createDataFrame([(p,) for p in near], "fingerprint long")
    edges = simhash._near_by_one_bit(prints)
    assert edges.count() <= 65 * len(near)
    assert simhash.linked(prints).select("root").distinct().count() == 1


def test_the_manhattan_distance_never_exceeds_the_bit_distance(spark):
    dice = random.Random(5)
    pairs = [(dice.getrandbits(63) - (1 << 62), dice.getrandbits(63) - (1 << 62)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a long, b long").select(
        "a",
        "b",
        simhash._manhattan(simhash._popcounts(F.col("a")), simhash._popcounts(F.col("b"))).alias("m"),
    )
    for r in df.collect():
        a, b = unsigned(r.a), unsigned(r.b)
        counts = [((a >> i & 3).bit_count(), (b >> i & 3).bit_count()) for i in range(0, 64, 2)]
        assert r.m == sum(abs(x - y) for x, y in counts) <= (a ^ b).bit_count()


def test_near_duplicates_and_what_stays(spark):
    base = [prose(i, 300) for i in range(6)]
    texts = base + base[:3] + [base[1] + " more", None, "", " "]
    docs = documents(spark, texts)
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    prints = {i: brute_print(t) for i, t in enumerate(texts)}
    assert found == brute_components(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    kept = sorted(r.doc_id for r in simhash.deduplicated(docs).collect())
    assert kept == sorted(set(found.values()))
    assert simhash.deduplicated(docs).columns == docs.columns


def test_odd_rows_and_empty_tables(spark):
    docs = odd_rows(spark).withColumn("fingerprint", F.lit("clash")).withColumn("root", F.lit(1))
    found = fully(simhash.near_duplicates(docs))
    assert len(found) == docs.count()
    # texts without a word share fingerprint 0; the smallest id that has it names the group
    assert {r["component_id"] for r in found if r["fingerprint"] == 0} == {1}
    kept = fully(simhash.deduplicated(docs))
    assert sum(r["doc_id"] == 4 for r in kept) == 1
    assert sum(r["doc_id"] == 5 for r in kept) == 2
    none = documents(spark, ["x"]).limit(0)
    assert simhash.near_duplicates(none).count() == simhash.deduplicated(none).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 199)]
    df = spark.createDataFrame([*edges, *edges[:5]], "u long, v long")
    found = {r.node: r.root for r in graph.components(df).collect()}
    expected = {i: 0 for i in range(61)} | {k: 100 for k in range(100, 160)} | {199: 199, 200: 199}
    assert found == expected
    assert graph.components(df.limit(0)).count() == 0


def test_deduplicated_keeps_columns_of_any_name(spark):
    names = ["_keep_id", "_keep_key", "keep_id", "text_key", "copy", "root", "fingerprint", "d", "first"]
    docs = documents(spark, ["a b c d e f"] * 2 + ["some other words are here"])
    docs = docs.selectExpr("*", *[f"{i} as {c}" for i, c in enumerate(names)])
    found = simhash.deduplicated(docs)
    assert found.columns == docs.columns
    rows = sorted(fully(found), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in rows] == [0, 2]
    assert all(r[c] == i for r in rows for i, c in enumerate(names))
