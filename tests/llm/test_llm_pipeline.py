"""The pipeline, and every registered query that SQL can express."""

from __future__ import annotations

import os

import pytest
from helpers import fully, words
from test_llm_decontaminate import brute_leaks
from test_llm_lines import brute as brute_lines
from test_llm_mixing import brute_targets
from test_llm_simhash import brute_components, brute_print

import corpus_pipeline
from feedloom.functions.frames import written
from feedloom.llm import toxicity
from feedloom.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@needs_data
def test_stages_match_brute_force_versions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, outs = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, FOLDER))
        assert i == 4 or docs.columns == columns
        outs.append({r["doc_id"]: r for r in fully(docs)} if i < 4 else fully(docs))
    clean, lines, unique, leakless, mixed = outs
    whole = fully(spark.read.parquet(f"{FOLDER}/documents.parquet"))

    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").filter(~toxicity.held_out("doc_id", 3, 1))
    model = toxicity.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"), labels)
    weight = dict(zip(model.bucket, model.weight))

    def log_odds(text):
        counts = toxicity.features(toxicity.text_words(text))
        return weight[-1] + sum(weight.get(f, 0) * n for f, n in counts.items())

    assert set(clean) == {r["doc_id"] for r in whole if log_odds(r["text"]) < 0.8472978603872034}

    ids = sorted(clean)
    cut = dict(zip(ids, brute_lines([clean[i]["text"] for i in ids], 50)))
    assert {i: r["text"] for i, r in lines.items()} == {
        i: t for i, t in cut.items() if words(t) or t == clean[i]["text"]
    }
    assert all(r["n_chars"] == len(r["text"]) for r in lines.values())

    prints = {i: brute_print(r["text"]) for i, r in lines.items()}
    root = brute_components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert set(unique) == set(root.values())

    items = fully(spark.read.parquet(f"{FOLDER}/benchmark.parquet"))
    # pairs without a common run of five words cannot be tiled
    def runs(text):
        w = text.lower().split()
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}

    dirty = set()
    for i, r in unique.items():
        near = [x["text"] for x in items if len(runs(r["text"]) & runs(x["text"])) > 1]
        if near and brute_leaks([r["text"]], near):
            dirty.add(i)
    assert set(leakless) == set(unique) - dirty

    sizes, taken = {}, {}
    for r in leakless.values():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(words(r["text"]))
    for r in mixed:
        taken[r["source"]] = taken.get(r["source"], 0) + len(words(r["text"]))
    largest = max(len(words(r["text"])) for r in leakless.values())
    for source, target in brute_targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= 2 * largest
    assert {(r["doc_id"], r["copy"]) for r in mixed} == {
        (r["doc_id"], n) for r in mixed for n in range(1, r["copies"] + 1)
    }
    assert len(mixed) == len({(r["doc_id"], r["copy"]) for r in mixed})


@needs_data
@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_sql(spark, name):
    from oracle_check import differences, open_tables

    assert differences(QUERIES[name](spark, FOLDER), open_tables(FOLDER), SQL[name]) == ""


@needs_data
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_other_queries_return_their_columns(spark, name):
    found = QUERIES[name](spark, FOLDER)
    n = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    rows = fully(found)
    if name == "op2_decontaminate":
        docs = {r["doc_id"]: r["text"] for r in fully(spark.read.parquet(f"{FOLDER}/documents.parquet"))}
        items = {r["item_id"]: r["text"] for r in fully(spark.read.parquet(f"{FOLDER}/benchmark.parquet"))}
        assert {(r["doc_id"], r["item_id"]) for r in rows} >= {
            (d, i) for d, t in docs.items() for i, x in items.items() if x in t
        }
        assert all(r["coverage"] >= 0.5 for r in rows)
    else:
        assert len(rows) == n and "doc_id" in found.columns
