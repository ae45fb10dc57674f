"""Every registered query against its SQL on DuckDB, and properties that all plans must have."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
import catalog
from tools.check_oracles import compare, duck

SF = "/root/testdata/sf0.01"
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_sql(spark, con, name):
    """The same rows as the SQL, by a plan without any all-pairs join or Python."""
    df = entry.queries()[name](spark, SF)
    assert compare(df, con, entry.oracle_sql()[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|NestedLoopJoin|EvalPython|MapInPandas|FlatMapGroups", plan)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["error_type", "count"]
    assert df.count() > 0


def test_sql_covers_the_queries():
    assert set(catalog.oracle_sql()) == set(catalog.queries())


def test_changed_files_are_many(spark, monkeypatch):
    """Both drops are written as many files, and each of the first is replaced under its name."""
    from catalog import sources

    seen, real = [], sources.replace_files

    def watched(t, source, target):
        before = set(sources.list_files(spark, target))
        real(t, source, target)
        seen.append((before, set(sources.list_files(spark, target)), sources.list_files(spark, source)))

    monkeypatch.setattr(sources, "replace_files", watched)
    entry.queries()["incremental_changed_file"](spark, "/root/testdata/sf0.001")
    before, after, left = seen[0]
    assert len(before) > 1 and before <= after and not list(left)
