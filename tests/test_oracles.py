"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest
from oracle_check import differences, open_tables

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) == ""


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).limit(5).count() == 5
