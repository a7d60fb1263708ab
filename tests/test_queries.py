"""Every registered query against its SQL twin, on the smallest data."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.oracle import check, connect

ROOT = Path(__file__).resolve().parent.parent
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, sf, name):
    _, _, problem = check(spark, con, name, QUERIES, SQL, sf)
    assert problem == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["quality", "term", "score", "rank"]


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_loads_without_an_installation_of_spark(tmp_path):
    """Queries and twins load where Spark's own files lie elsewhere, without a session or a JVM."""
    code = f"""
import pyspark, sys
pyspark.__file__ = {str(tmp_path / "__init__.py")!r}
import __spark_entry__ as entry
assert len(entry.oracle_sql()) > 100 and set(entry.oracle_sql()) <= set(entry.queries())
from pyspark import SparkContext
assert SparkContext._active_spark_context is None
"""
    env = {k: v for k, v in os.environ.items() if k not in ("SPARK_HOME", "JAVA_HOME")}
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
