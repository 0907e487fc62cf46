from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from feedloom.llm.conversation_trie import Parentheses, prefix_nodes, sequences
from helpers import fully, words

CONVERSATIONS = "conv_id long, turn long, role string, text string"


def brute(spoken):
    """Nodes of {conv_id: [(role, text), ...]} by walking every prefix."""
    members, children = defaultdict(list), defaultdict(set)
    for conv, turns in spoken:
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    ends = defaultdict(list)
    for conv, turns in spoken:
        ends[tuple(turns)].append(conv)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        out.append(
            {
                "conv_id": min(convs),
                "depth": len(path),
                "parent_conv_id": min(members[path[:-1]]) if path else None,
                "n_convs": len(convs),
                "n_children": len(children[path]),
                "n_leaves": sum(not children[p] for p in below),
                "saved_tokens": sum((len(members[p]) - 1) * len(words(p[-1][1])) for p in below if p),
                "ends_sha256": hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest(),
            }
        )
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r["depth"], r["ends_sha256"], r["conv_id"]))


def drawn(seed, n):
    dice = random.Random(seed)
    turns = [("user", "a b c"), ("user", "a"), ("model", ""), ("", "x y")]
    return [(i * 7 - 20, [dice.choice(turns) for _ in range(dice.choice([1, 2, 2, 3, 5, 9]))]) for i in range(n)]


def table(spark, spoken):
    rows = [(c, i, r, t) for c, turns in spoken for i, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, CONVERSATIONS)


@pytest.mark.parametrize("per_shard", [2, 20, 100_000])
def test_nodes_equal_brute_force_however_shards_are_cut(spark, per_shard):
    spoken = drawn(3, 60)
    found = fully(prefix_nodes(sequences(table(spark, spoken)), per_shard))
    assert in_order(found) == in_order(brute(spoken))


def test_copies_of_one_conversation_and_a_long_one(spark):
    long = [("user", f"turn {i}") for i in range(700)]
    spoken = [(i, [("user", "hi there"), ("model", "yes")]) for i in range(9000)]
    spoken += [(9000, long), (9001, long[:650]), (9002, [*long[:300], ("user", "other")])]
    found = {(r["conv_id"], r["depth"]): r for r in fully(prefix_nodes(sequences(table(spark, spoken)), 500))}
    assert found[0, 0]["n_convs"] == 9003 and found[0, 0]["n_leaves"] == 3
    assert found[0, 2]["n_convs"] == 9000
    ids = ",".join(map(str, range(9000)))
    assert found[0, 2]["ends_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
    shared = 2 * 2 * 300 + 1 * 2 * 350
    assert found[9000, 1]["saved_tokens"] == shared
    assert found[0, 0]["saved_tokens"] == shared + 8999 * 3
    assert found[9000, 300]["n_children"] == 2 and found[9000, 300]["n_leaves"] == 2


def test_nulls_ties_repeated_rows_and_empty_tables(spark):
    rows = [
        (None, 0, "user", "no conversation"),
        (1, None, None, None),
        (1, 0, "user", "x"),
        (2, 0, "", ""),
        (2, 1, "user", "x"),
        (3, 5, "user", "x"),
        (3, 5, "user", "x"),
        (4, 5, "user", "y"),
        (4, 5, "user", "x"),
        (5, 5, "user", "x"),
        (5, 5, "user", "y"),
    ]
    odd = spark.createDataFrame([(*r, "extra", 1) for r in rows], CONVERSATIONS + ", turns string, a int")
    found = fully(prefix_nodes(sequences(odd)))
    ends = Counter(r["ends_sha256"] for r in found)
    assert ends[hashlib.sha256(b"1,2").hexdigest()] == 1  # null turn first, null text as empty
    assert ends[hashlib.sha256(b"3").hexdigest()] == 1  # a repeated row is a repeated turn
    assert ends[hashlib.sha256(b"4,5").hexdigest()] == 1  # ties are ordered by what is said
    assert next(r for r in found if r["depth"] == 0)["n_convs"] == 5
    assert fully(prefix_nodes(sequences(odd.limit(0)))) == []


def test_conversations_without_turns_end_at_the_root(spark):
    kind = "conv_id long, turns array<struct<a:bigint,b:bigint,words:bigint>>"
    found = fully(prefix_nodes(spark.createDataFrame([(4, []), (-2, [])], kind)))
    assert [(r["conv_id"], r["n_convs"], r["n_leaves"], r["parent_conv_id"]) for r in found] == [(-2, 2, 1, None)]
    assert found[0]["ends_sha256"] == hashlib.sha256(b"-2,4").hexdigest()


@pytest.mark.parametrize("shape", ["deep", "wide", "drawn"])
def test_findclose_and_leaf_pairs(shape):
    dice = random.Random(5)
    steps = {"deep": [1] * 900 + [-1] * 900, "wide": [1] + [1, -1] * 900 + [-1]}.get(shape)
    if steps is None:
        steps, depth = [1], 1
        while depth:
            step = 1 if len(steps) < 3000 and (depth == 1 or dice.random() < 0.55) else -1
            steps.append(step)
            depth += step
    stack, close = [], {}
    for i, step in enumerate(steps):
        if step > 0:
            stack.append(i)
        else:
            close[stack.pop()] = i
    tree = Parentheses(np.array(steps))
    opens = np.flatnonzero(np.array(steps) > 0)
    closes = tree.findclose(opens)
    assert closes.tolist() == [close[i] for i in opens.tolist()]
    pairs = [sum(steps[i] > 0 > steps[i + 1] for i in range(a, b)) for a, b in zip(opens, closes)]
    assert tree.leaf_pairs(opens, closes).tolist() == pairs
