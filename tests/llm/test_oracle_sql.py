"""The stated SQL gives the same rows as the queries."""

import pytest
from oracle_check import connect, difference

from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, data, name):
    assert difference(QUERIES[name](spark, data), connect(data), ORACLE[name]) is None


@pytest.mark.parametrize("name", ["op2_licenses", "op5_decontaminate", "op10_chat"])
def test_native_queries_run_no_python(spark, data, name):
    plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian"))


def test_all_are_registered():
    import __spark_entry__

    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())
