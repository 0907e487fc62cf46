from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from feedloom.llm import queries, suffix_buckets
from feedloom.llm.suffix_buckets import refined, without_repeats
from helpers import documents, fully, odd_rows, prose

LAST = 2**63


def brute(rows, width):
    """(kept, n_removed, n_spans) of each (doc_id, text), from the smallest id of every window."""
    least = {}
    texts = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for a in range(len(t) - width + 1):
            w = t[a : a + width]
            least[w] = min(least.get(w, LAST), i)
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for a in range(len(t) - width + 1):
            if least[t[a : a + width]] < i:
                gone[a : a + width] = True
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((kept, int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) > 0).sum())))
    return out


def drawn(seed, n):
    """Texts with copies, shared passages at all offsets, and repeating bytes."""
    dice = random.Random(seed)
    passages = [prose(100 + i, dice.randrange(8, 60), 300) for i in range(5)]
    texts = []
    for i in range(n):
        parts = [prose(seed * 1000 + i * 10 + j, dice.randrange(30), 50) for j in range(dice.randrange(4))]
        for _ in range(dice.randrange(3)):
            p = dice.choice(passages)
            a = dice.randrange(len(p) // 2)
            parts.insert(dice.randrange(len(parts) + 1), p[a : a + dice.randrange(len(p))])
        text = " ".join(parts)
        texts.append(dice.choice(texts) if texts and dice.random() < 0.1 else text)
    return [*texts, None, "", "é" * 90, "ab" * 200, "b" + "ab" * 60, "é" * 60, "x" * 49]


def results(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", bytes(r["kept"]), r["n_removed"], r["n_spans"]) for r in fully(df))


def expected(rows, width):
    return sorted((i is None, i or 0, t or "", *b) for (i, t), b in zip(rows, brute(rows, width)))


@pytest.mark.parametrize("width", [50, 12, 2])
def test_equals_brute_force(spark, width):
    texts = drawn(width, 60)
    rows = list(enumerate(texts))
    df = documents(spark, texts).repartition(3)
    assert results(without_repeats(df, width=width)) == expected(rows, width)


def test_hot_buckets_and_cut_texts_change_nothing(spark, monkeypatch):
    """With every q-gram that a task sees twice held for hot."""
    monkeypatch.setattr(suffix_buckets, "_HOT_ITEMS", 1)
    texts = drawn(7, 50)
    texts += [prose(1, 40) + f" {i}" for i in range(30)]
    df = documents(spark, texts).coalesce(1)
    assert len(suffix_buckets._hot_names(suffix_buckets._keyed(df, "doc_id", "text"), 50))
    assert results(without_repeats(df)) == expected(list(enumerate(texts)), 50)


def test_long_texts_are_cut_with_overlaps():
    data = prose(3, 2000).encode()
    whole = [np.concatenate(x) for x in zip(*(suffix_buckets._items(p, 50, np.empty(0, np.uint64)) for p in suffix_buckets._slices([data], 50)))]
    before, suffix_buckets._SLICE = suffix_buckets._SLICE, 64
    try:
        cut = [np.concatenate(x) for x in zip(*(suffix_buckets._items(p, 50, np.empty(0, np.uint64)) for p in suffix_buckets._slices([data], 50)))]
    finally:
        suffix_buckets._SLICE = before
    places = [sorted((lo + i, name) for name, lo, n in zip(x[1], x[3], x[4]) for i in range(n)) for x in (whole, cut)]
    assert places[0] == places[1]
    assert [p[0] for p in places[0]] == list(range(len(data) - 49))


@pytest.mark.parametrize("width", [50, 3, 8, 33])
def test_refinement_tells_windows_apart(width):
    dice = np.random.default_rng(width)
    data = dice.integers(0, 2, 3000).astype(np.uint8)
    data[2000:2300] = data[100:400]
    ends = np.repeat([1500, 3000], 1500)
    pointer = refined(data, ends, width)
    groups = {}
    for i in range(3000):
        if i + width <= ends[i]:
            groups.setdefault(data[i : i + width].tobytes(), []).append(i)
    for own in groups.values():
        assert len(set(pointer[own])) == 1 and (pointer[own[0]] >= 0) == (len(own) > 1)
    assert len({pointer[g[0]] for g in groups.values() if len(g) > 1}) == sum(len(g) > 1 for g in groups.values())


def test_odd_rows_and_clashing_names(spark):
    odd = odd_rows(spark)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert results(without_repeats(odd)) == expected(rows, 50)
    columns = ["kept", "N_Removed", "row_spans", "d", "k", "t", "lo", "bucket"]
    clash = documents(spark, ["a" * 60, "a" * 60]).selectExpr("*", *[f"1 as {c}" for c in columns])
    found = without_repeats(clash)
    assert found.columns == [*clash.columns, "_kept", "_n_removed", "n_spans"]
    assert [r["_n_removed"] for r in sorted(fully(found), key=lambda r: r["doc_id"])] == [0, 60]
    assert without_repeats(odd.limit(0)).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    texts = drawn(9, 80)
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(map(tuple, queries.op12_suffix_dedup(spark, str(tmp_path)).collect()))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert found == [
        (i, len((t or "").encode()), gone, spans, sha(kept))
        for i, (t, (kept, gone, spans)) in enumerate(zip(texts, brute(list(enumerate(texts)), 50)))
    ]
