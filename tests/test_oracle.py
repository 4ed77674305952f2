"""Every query that SQL can express gives DuckDB's rows."""

import pytest
from compare import difference, duck
from conftest import SMALL

import __spark_entry__ as entry_point

ORACLE = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_duckdb(spark, con, name):
    query = entry_point.queries()[name]
    assert difference(query(spark, SMALL), con, ORACLE[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry_point.queries())


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() == 1


def test_registry_needs_no_session():
    import subprocess
    import sys

    root = entry_point.__file__.rsplit("/", 1)[0]
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
