"""Joins of exploded rows or rows per line are not sent through the driver, however small Spark thinks they are."""

from __future__ import annotations

from feedloom.llm import graph, lines, simhash


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_grid_joins_of_simhash_are_not_broadcast(spark, monkeypatch):
    plans = []

    def seen(edges):
        plans.append(_plan(edges))
        return graph.components(edges)

    monkeypatch.setattr(simhash, "components", seen)
    prints = spark.createDataFrame([(0,), (1,), (3,), (0xFF00,), (0xFF01,), (1 << 40,)], "fingerprint long")
    roots = {r["fingerprint"]: r["root"] for r in simhash.linked(prints).collect()}
    assert roots == {0: 0, 1: 0, 3: 0, 0xFF00: 0xFF00, 0xFF01: 0xFF00, 1 << 40: 0}
    assert len(plans) == 2
    for plan in plans:
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_line_names_are_not_broadcast(spark, monkeypatch):
    plans = []
    real = lines.written

    def seen(df):
        plans.append(_plan(df))
        return real(df)

    monkeypatch.setattr(lines, "written", seen)
    text = "\n".join(f"line {i} of a text that comes twice" for i in range(12))
    docs = spark.createDataFrame([(1, text), (2, f"{text}\nand an end")], "doc_id long, text string")
    spans = lines.repeated_runs(docs, min_words=50).collect()
    assert [(r["d"], r["first_line"], r["last_line"]) for r in spans] == [(2, 0, 11)]
    keyed = next(p for p in plans if "first_line" in p and "n1" in p)
    assert "SortMergeJoin" in keyed and "Broadcast" not in keyed
