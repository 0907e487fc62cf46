"""Quality rules, token counts and URL filters."""

from __future__ import annotations

import datetime
import os
import random
from fractions import Fraction
from math import comb

import numpy as np
import pytest
from helpers import documents, fully, odd_rows, prose, words

from feedloom.llm import quality, token_counts, url_filters
from feedloom.llm.queries import TOKENIZERS
from pyspark.sql import functions as F


def brute_counts(text):
    w = words(text)
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {i + s for i, t in enumerate(triples) if triples.count(t) > 1 for s in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text or ""),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(covered),
        len(lines),
    )


def test_text_counts_match_a_plain_version():
    dice = random.Random(1)
    texts = [None, "", " ", "a\xa0b c\x1cd", "é\U0001f600 #x\n#x\n\n \n#x y"]
    texts += ["".join(dice.choice(["a ", "b ", "c ", "\n", "# ", "d\t"]) for _ in range(60)) for _ in range(40)]
    for text in texts:
        assert quality.text_counts(text) == brute_counts(text)


def test_binomial_tails_are_exact():
    for n, k, p in ((10, 0, 0.01), (200, 3, 0.01), (50, 49, 0.5), (5, 5, 0.3), (1000, 4, 0.01)):
        q = Fraction(p)
        exact = sum(comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1))
        assert quality.binomial_tail(n, k, p) == pytest.approx(float(exact), rel=1e-9)


def test_cutoffs_keep_the_promise_and_catch_junk(spark):
    dice = random.Random(2)
    texts, labels = [], []
    for i in range(1600):
        junk = i % 8 == 0
        w = [f"{'###' if junk else ''}w{dice.randrange(900)}" for _ in range(70)]
        if not junk and i % 400 == 1:
            w = ["#" + x for x in w]
        texts.append(" ".join(w))
        labels.append((i, int(not junk)))
    docs = documents(spark, texts).withColumn("lang", F.when(F.col("doc_id") % 16 == 3, "xx").otherwise("en"))
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = fully(quality.judged(docs, known))
    good = [r for r in rows if r["doc_id"] % 8 and r["stratum"] == "en"]
    junk = [r for r in rows if r["doc_id"] % 8 == 0 and r["stratum"] == "en"]
    assert sum(not r["kept"] for r in good) <= 0.05 * len(good)
    assert junk and not any(r["kept"] for r in junk)
    # a hundred labels prove nothing at this level: no rule is on there
    assert all(r["kept"] for r in rows if r["stratum"] == "xx")


def test_quality_odd_rows_and_empty_tables(spark):
    docs = odd_rows(spark).withColumn("n_words", F.lit("clash")).withColumn("kept", F.lit("clash"))
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (5, None)], "doc_id long, quality int")
    rows = fully(quality.judged(docs, labels))
    assert len(rows) == docs.count()
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["doc_id"] != 4)
    assert [r["n_words"] for r in rows if r["doc_id"] == 4] == [30_000] * 2
    assert quality.judged(docs, labels.limit(0)).count() == docs.count()
    assert quality.judged(docs.limit(0), labels).count() == 0


RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
needs_ranks = pytest.mark.skipif(not os.path.exists(RANKS), reason="no rank file")


@needs_ranks
@pytest.mark.parametrize("seed", range(3))
def test_trees_follow_edits_exactly(seed):
    counter = token_counts.Counter(token_counts.read_ranks(RANKS))
    dice = random.Random(seed)
    letters = ["a", "b", " ", "  ", "\n", "'s", "'", "12", "é", ".", "!?", "日本", " the", "\t", " x"]
    for _ in range(250):
        text = "".join(dice.choice(letters) for _ in range(dice.choice([0, 1, 3, 30, 200])))
        tree = token_counts.TokenTree(text, counter)
        for _ in range(dice.randint(1, 6)):
            start = dice.randint(0, len(text) + 1)
            stop = start + dice.randint(0, dice.choice([0, 2, 10, 60]))
            new = "".join(dice.choice(letters) for _ in range(dice.randint(0, 4)))
            tree.edit(start, stop, new)
            start = min(start, len(text))
            text = text[:start] + new + text[max(start, min(stop, len(text))) :]
            assert tree.whole() == text
            assert tree.total == len(counter.encoding.encode_ordinary(text))


@needs_ranks
def test_an_edit_reads_little_of_a_long_text():
    counter = token_counts.Counter(token_counts.read_ranks(RANKS))
    tree = token_counts.TokenTree(prose(1, 50_000), counter)
    for place in (0, 7, 100_000, 200_000):
        tree.edit(place, place + 5, "new words")
    assert tree.read < 400


@needs_ranks
def test_edits_after_large_and_many_insertions_read_little():
    counter = token_counts.Counter(token_counts.read_ranks(RANKS))
    text = prose(1, 2_000)
    tree = token_counts.TokenTree(text, counter)

    def change(start, stop, new):
        nonlocal text
        read = tree.read
        tree.edit(start, stop, new)
        text = text[:start] + new + text[stop:]
        return tree.read - read

    change(500, 500, prose(2, 40_000))
    dice = random.Random(4)
    places = [0, 499, 501, 100_000, *[dice.randrange(len(text)) for _ in range(40)]]
    assert max(change(p, p + 3, "abc") for p in places) < 400
    assert max(change(1_000, 1_000, f" w{i}") for i in range(2_000)) < 400
    # nearly all goes, then what is left is edited
    change(1_000, len(text) - 300, "")
    assert max(change(p, p + 2, "x y") for p in (0, 990, 1_000, 1_010, 1_250)) < 400
    for _ in range(60):
        change(200, 207, "")
    assert change(200, 200, "z") < 400
    assert tree.whole() == text
    assert tree.total == len(counter.encoding.encode_ordinary(text))


@needs_ranks
def test_an_edit_of_many_leaves_updates_the_tree_once(monkeypatch):
    counter, calls = token_counts.Counter(token_counts.read_ranks(RANKS)), []
    text = prose(3, 300)
    lengths, tokens = counter.leaves(text)
    assert lengths.tolist() == [len(p) for p in counter.pieces(text)] and tokens.sum() == len(counter.encoding.encode_ordinary(text))
    tree, plain = token_counts.TokenTree(text, counter), token_counts.TokenTree._set
    monkeypatch.setattr(token_counts.TokenTree, "_set", lambda *a: calls.append(1) or plain(*a))
    for place in (0, 500, 1_000):
        tree.edit(place, place + 40, "four words in place")
    assert len(calls) == 3
    for sums in (tree.chars, tree.tokens):
        assert all(sums[i] == sums[2 * i] + sums[2 * i + 1] for i in range(1, tree.first))


@needs_ranks
def test_edits_as_a_job_and_stored_trees(spark):
    ranks = token_counts.read_ranks(RANKS)
    docs = documents(spark, [prose(i, 80) for i in range(20)] + [None, "", "日本 'tis"])
    edits = token_counts.drawn_edits("doc_id", "text")
    rows = {r["doc_id"]: r for r in fully(token_counts.edited_counts(docs.withColumn("edits", edits), ranks))}
    counter = token_counts.Counter(ranks)
    changes = {r.doc_id: (r.text or "", r.edits) for r in docs.withColumn("edits", edits).collect()}
    for i, (text, todo) in changes.items():
        assert rows[i]["tokens_before"] == len(counter.encoding.encode_ordinary(text))
        for e in todo:
            start = min(e.start, len(text))
            text = text[:start] + e.new + text[max(start, min(e.stop, len(text))) :]
        assert rows[i]["tokens_after"] == len(counter.encoding.encode_ordinary(text))
        assert rows[i]["chars_after"] == len(text)
    stored = token_counts.edited_counts(docs.withColumn("edits", F.expr("cast(null as array<struct<start:int,stop:int,new:string>>)")), ranks, keep_leaves=True)
    kept = stored.select("doc_id", "leaves").join(docs, "doc_id").withColumn("edits", edits)
    again = {r["doc_id"]: r for r in fully(token_counts.edited_counts(kept, ranks, leaves="leaves"))}
    assert {i: r["tokens_after"] for i, r in again.items()} == {i: r["tokens_after"] for i, r in rows.items()}


def test_packed_leaves_come_back():
    dice = random.Random(11)
    for n in (0, 1, 5, 4000):
        pairs = [(dice.choice([0, 1, 5, 62, 63, 64, 90_000]), dice.choice([0, 1, 2, 3, 4, 40_000])) for _ in range(n)]
        lengths, tokens = (np.array(x, np.int64) for x in (zip(*pairs) if pairs else ((), ())))
        again = token_counts.unpacked(token_counts.packed(lengths, tokens))
        assert all((a == b).all() and len(a) == n for a, b in zip(again, (lengths, tokens)))
    # usual pre-tokens take a byte
    assert len(token_counts.packed(np.full(1000, 6), np.ones(1000, int))) == 1004


@needs_ranks
def test_token_counts_odd_rows_and_empty_tables(spark):
    ranks = token_counts.read_ranks(RANKS)
    docs = odd_rows(spark).withColumn(
        "edits", F.expr("array(null, named_struct('start', null, 'stop', 3, 'new', null), named_struct('start', 9, 'stop', 2, 'new', 'x'))")
    )
    docs = docs.withColumn("tokens_after", F.lit("clash")).withColumn("leaves", F.lit("kept"))
    rows = fully(token_counts.edited_counts(docs, ranks))
    assert len(rows) == docs.count() and {r["leaves"] for r in rows} == {"kept"}
    stored = token_counts.stored_trees(docs, ranks)
    again = fully(token_counts.edited_counts(stored, ranks, leaves="leaves"))
    assert sorted(map(repr, again)) == sorted(repr({c: v for c, v in r.items() if c != "leaves"}) for r in rows)
    assert {r["tokens_before"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert {r["tokens_after"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert token_counts.edited_counts(docs.limit(0), ranks).count() == 0


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=n)


def brute_urls(captures, entries):
    """For every capture, replay all entries up to its day."""
    out = {}
    for i, url, at in captures:
        host = rest = None
        if url and "://" in url:
            body = url.split("://", 1)[1].split("#")[0]
            cut = min([body.index(c) for c in "/?" if c in body], default=len(body))
            host, rest = body[:cut].split("@")[-1].split(":")[0].lower().rstrip("."), body[cut:]
        place = host and host + "/" + "/".join(p for p in rest.split("?")[0].split("/") if p) + "/"
        active = set()
        for name, kind, value, dated, action in sorted(entries, key=lambda e: (e[3], e[4] == "add")):
            if at is not None and dated <= at:
                (active.add if action == "add" else active.discard)((name, kind, value))
        hits = [
            e for e in active if host and (
                (e[1] == "host" and e[2] == host) or (e[1] == "url" and e[2] == host + rest)
                or (e[1] == "domain" and (host == e[2] or host.endswith("." + e[2])))
                or (e[1] == "folder" and place.startswith(e[2] + "/"))
            )
        ]
        out[i] = (len(hits), min((e[0] for e in hits), default=None))
    return out


def test_captures_match_a_replay_of_the_lists(spark):
    dice = random.Random(6)
    hosts = ["a.example.com", "b.example.com", "example.com", "x.y.example.org", "lone"]
    entries = []
    for _ in range(120):
        host = dice.choice(hosts)
        kind, value = dice.choice([
            ("host", host), ("domain", host), ("domain", "example.com"), ("folder", f"{host}/en"),
            ("folder", f"{host}/en/1"), ("url", f"{host}/en/1?p=2"), ("url", host),
        ])
        entries.append((dice.choice("pqr"), kind, value, day(dice.randrange(400)), dice.choice(["add", "add", "remove"])))
    urls = [
        f"{dice.choice(['http', 'https'])}://{dice.choice(['', 'me@', 'WWW.'])}{dice.choice(hosts)}{dice.choice(['', ':80'])}"
        f"{dice.choice(['', '/', '/en', '/en/1', '/en/1?p=2', '/EN/1#top', '?q=1', '//en//1/'])}"
        for _ in range(150)
    ] + [None, "", "no url", "/relative/en"]
    captures = [(i, u, None if i % 40 == 39 else day(dice.randrange(400))) for i, u in enumerate(urls)]
    found = url_filters.judged(
        spark.createDataFrame(captures, "page_id long, url string, fetched date"),
        spark.createDataFrame(entries + entries[:9], "list string, kind string, value string, dated date, action string"),
    )
    rows = {r["page_id"]: (r["n_entries"], r["first_list"]) for r in fully(found)}
    assert rows == brute_urls(captures, entries)
    assert sum(n > 0 for n, _ in rows.values()) > 30


def test_folders_of_any_depth_are_asked_for(spark):
    path = "/".join(f"p{i}" for i in range(30))
    captures = spark.createDataFrame(
        [(n, f"http://a.b/{'/'.join(path.split('/')[:n])}/x.html", day(9)) for n in (7, 8, 9, 29)],
        "page_id long, url string, fetched date",
    )
    entries = spark.createDataFrame(
        [("l", "folder", f"a.b/{'/'.join(path.split('/')[:n])}", day(1), "add") for n in (8, 9, 29)],
        "list string, kind string, value string, dated date, action string",
    )
    found = {r["page_id"]: r["n_entries"] for r in fully(url_filters.judged(captures, entries))}
    assert found == {7: 0, 8: 1, 9: 2, 29: 3}


def test_urls_odd_rows_and_empty_tables(spark):
    rows = [(1, "http://a.b/c", day(3)), (1, "http://a.b/c", day(3)), (None, None, None), (2, "http://" + "x" * 50_000, day(1))]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched date").withColumn("rid", F.lit("clash")).withColumn("at", F.lit(1))
    for name in ("n", "l", "_rid", "asks", "month", "list", "host"):
        captures = captures.withColumn(name, F.lit("clash"))
    entries = spark.createDataFrame(
        [("l", "host", "a.b", day(3), "add"), ("l", "host", None, day(1), "add"), (None, "host", "a.b", day(1), "add"), ("l", "host", "a.b", None, "add"), ("l", "host", "a.b", day(3), "remove"), ("l", "host", "a.b", day(1), "odd")],
        "list string, kind string, value string, dated date, action string",
    )
    found = fully(url_filters.judged(captures, entries))
    assert sorted((r["page_id"] or 0, r["n_entries"]) for r in found) == [(0, 0), (1, 1), (1, 1), (2, 0)]
    assert {(r["n"], r["l"], r["_rid"], r["list"]) for r in found} == {("clash",) * 4}
    assert {r["host"] for r in found if r["page_id"] == 1} == {"a.b"}
    assert url_filters.judged(captures, entries.limit(0)).filter("blocked").count() == 0
    assert url_filters.judged(captures.limit(0), entries).count() == 0
