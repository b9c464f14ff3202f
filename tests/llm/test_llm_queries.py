"""Queries of the operators against DuckDB on the smallest tables."""

import pytest
from compare import TESTDATA, compare, duck

import __spark_entry__ as spark_entry
from sluicegate.llm import ORACLES, QUERIES

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def other():
    return duck(SF)


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) <= set(spark_entry.queries()) and "pipeline" in spark_entry.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_duckdb(spark, other, name):
    rows, problem = compare(spark, other, QUERIES[name], ORACLES[name], SF)
    assert problem is None
