"""Registered queries against their DuckDB SQL (all of them: ``python tests/oracle_check.py SF_DIR``)."""

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry
from notemask.plans.queries import ORACLE, QUERIES

@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, sf_dir, name):
    query, sql = QUERIES[name], ORACLE[name]
    assert compare(spark, duck(sf_dir), sf_dir, name, query, sql) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc_id", "text", "cleaned", "iob", "masked"]
