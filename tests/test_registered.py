"""Every registered query against DuckDB on the smallest tables."""

import os
import shutil
import subprocess
import sys

import pytest
from compare import TESTDATA, compare, duck

import __spark_entry__ as spark_entry
from sluicegate.registered import ORACLES, QUERIES

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def other():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_duckdb(spark, other, name):
    rows, problem = compare(spark, other, spark_entry.queries()[name], spark_entry.oracle_sql()[name], SF)
    assert problem is None


def test_queries_without_sql(spark):
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def test_the_rest_lives_without_the_optional_modules(tmp_path):
    """In a copy without them, the entry point imports and registers all other queries."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in ("sluicegate", "__spark_entry__.py"):
        source = os.path.join(root, name)
        copy = shutil.copytree if os.path.isdir(source) else shutil.copy
        copy(source, tmp_path / name, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if copy is shutil.copytree else {}))
    (tmp_path / "corpus_pipeline.py").write_text("from sluicegate.llm import nothing\n")
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLES)), "False"]
