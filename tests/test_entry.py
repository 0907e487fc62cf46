"""The driver's entry, whole and without the text operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, "tests")
import __spark_entry__ as entry
from oracle_check import session
names = set(entry.queries())
assert not [n for n in names if n.startswith("op1") or n == "pipeline"], names
assert set(entry.oracle_sql()) <= names
print("ROWS", entry.queries()["group_sizes"](session(2), "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize("pipeline_stays", [True, False])
def test_entry_without_the_text_operators(tmp_path, pipeline_stays):
    tree = str(tmp_path / "tree")
    shutil.copytree(ROOT, tree, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    if not pipeline_stays and os.path.exists(f"{tree}/corpus_pipeline.py"):
        os.remove(f"{tree}/corpus_pipeline.py")
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tree, env=clean, capture_output=True, text=True, timeout=300
    )
    assert "ROWS" in done.stdout, done.stderr[-2000:]


def test_matrix_methods_are_small_enough_to_be_compiled(spark):
    """The JVM interprets methods of over 8,000 bytes; with and without broadcasts the matrix has none."""
    from feedloom.plans.queries import REGISTRY

    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    for limit in ("10485760", "-1"):
        session = spark.newSession()
        session.conf.set("spark.sql.adaptive.enabled", "false")
        session.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        plan = REGISTRY["feature_matrix"](session, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
        found = debug.codegenStringSeq(plan)
        assert max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.size())) <= 8000


def test_only_what_a_query_reads_is_written(spark, monkeypatch):
    from feedloom.plans import queries

    tables, written = [], queries.written
    monkeypatch.setattr(queries, "written", lambda df: tables.append(df.columns) or written(df))
    for name, inputs in (("attribution_fixed_weights", 3), ("permutation_importance", 4)):
        tables.clear()
        queries.REGISTRY[name](spark, "/root/testdata/sf0.001")
        assert len(tables[-1]) == 5 + inputs  # and the keys, label and split
    tables.clear()
    queries.REGISTRY["feature_column_names"](spark, "/root/testdata/sf0.001")
    assert not any("ctx_hour" in columns for columns in tables)
