from __future__ import annotations

import hashlib
import random
from zlib import crc32

import numpy as np
import pytest

from feedloom.llm import queries
from feedloom.llm.periodic_runs import RangeMin, SuffixTree, _text_runs, periodic_runs, runs_of
from helpers import documents, fully, odd_rows, prose, words


def brute(w, least_words=6, least_times=4):
    """All runs, by comparing words q apart for every q."""
    n, out = len(w), []
    for q in range(1, n // least_times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least_words, least_times * q):
                part = w[i : i + size]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def drawn(seed):
    dice = random.Random(seed)
    n, letters = dice.randrange(40), dice.choice([1, 2, 2, 3, 5])
    w = [b"%d" % dice.randrange(letters) for _ in range(n)]
    if n > 8 and dice.random() < 0.5:
        a = dice.randrange(n)
        p = 1 + (n - a) // dice.randrange(3, 9)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (6, 3)])
def test_runs_equal_brute_force(limits):
    texts = [drawn(i) for i in range(600)]
    assert _text_runs(texts, *limits) == [brute(w, *limits) for w in texts]


def test_extensions_equal_comparison():
    dice = random.Random(2)
    for _ in range(30):
        s = [dice.randrange(1, 4) for _ in range(dice.randrange(2, 80))]
        tree, n = SuffixTree(s), len(s)
        pairs = [(i, j) for i in range(n) for j in range(i + 1, n + 1)]
        a, b = np.array(pairs).T
        got = tree.common(a, b)
        for i, j, k in zip(a, b, got):
            assert s[i : i + k] == s[j : j + k] and (j + k == n or s[i + k] != s[j + k])
        ranked = sorted(range(n + 1), key=lambda x: s[x:])
        assert np.argsort(tree.order(False)).tolist() == ranked
        ranked = sorted(range(n + 1), key=lambda x: [-y for y in s[x:]])
        assert np.argsort(tree.order(True)).tolist() == ranked


def test_range_minimum():
    values = np.random.default_rng(1).integers(0, 1000, 333)
    least = RangeMin(values)
    a, b = np.random.default_rng(2).integers(0, 333, (2, 4000))
    assert least.of(a, b).tolist() == [values[min(x, y) : max(x, y) + 1].min() for x, y in zip(a, b)]


def test_long_texts_of_one_word_and_of_long_periods():
    assert runs_of(np.ones(30_000, int)).tolist() == [[0, 30_000, 1]]
    group = np.random.default_rng(3).integers(1, 500, 5000)
    assert [0, 20_003, 5000] in runs_of(np.concatenate([np.tile(group, 4), group[:3]])).tolist()
    assert len(runs_of(np.empty(0, int))) == 0


def test_odd_rows_and_clashing_names(spark):
    found = fully(periodic_runs(odd_rows(spark)))
    assert len(found) == 10 and all(r["runs"] == [] for r in found)
    assert sorted(r["collapsed"] for r in found if not words(r["text"])) == [b""] * 4
    assert all(bytes(r["collapsed"]) == " ".join(words(r["text"])).encode() for r in found)
    docs = documents(spark, ["so " * 9 + "on", " the\nthe the the  the the the"]).selectExpr("*", "1 as runs", "2 as Collapsed")
    found = periodic_runs(docs)
    assert found.columns == [*docs.columns, "_runs", "_collapsed"]
    first, second = sorted(fully(found), key=lambda r: r["doc_id"])
    assert first["_runs"] == [{"start": 0, "length": 9, "period": 1}] and bytes(first["_collapsed"]) == b"so on"
    assert second["_runs"] == [] and second["runs"] == 1
    assert periodic_runs(odd_rows(spark).limit(0)).count() == 0


def expected(doc_id, text):
    w = words(text)
    h, n = crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{m},{q}\n" for s, m, q in runs), kept)]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha)


def test_query_equals_brute_force(spark, tmp_path):
    dice = random.Random(4)
    texts = [prose(i, dice.randrange(90), 30) for i in range(250)]
    texts += [None, "", "a " * 12, "x y " * 9 + "x", "\n".join(prose(9, 20, 5).split())]
    documents(spark, texts).coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_periodic_runs(spark, str(tmp_path))
    assert found.columns[:6] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    assert sorted(map(tuple, found.collect())) == [expected(i, t) for i, t in enumerate(texts)]
