"""The registered queries of the package against their SQL on DuckDB, and what must hold for their plans."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from emberlog.llm import queries
from tools.check_oracles import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_agrees_with_sql(spark, name):
    assert compare(queries.queries()[name](spark, SF), duck(SF), queries.oracle_sql()[name]) is None


def test_all_are_registered():
    names = entry.queries()
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)) and "pipeline" in names
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_decontamination_is_native(spark):
    plan = queries.queries()["op4_decontaminate"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)
