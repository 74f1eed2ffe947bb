"""Registered corpus queries against DuckDB SQL, or against their own contract where SQL can't express them."""

import pytest
from oracle_check import compare, duck

from notemask.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, sf_dir, name):
    assert compare(spark, duck(sf_dir), sf_dir, name, QUERIES[name], ORACLE[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op1_chat_formatting", "op7_exact_dedup"])
def test_native_plans_have_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
