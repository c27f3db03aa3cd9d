"""Every checked query against its DuckDB oracle on the driver's test data."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from lakeshore import job_queries, queries as library
from tests.conftest import SF_SMOKE
from tools.oracle_check import compare, duck_connection

ALL, SQL = entry.queries(), entry.oracle_sql()
QUERIES = {name: ALL[name] for name in {**library.QUERIES, **job_queries.QUERIES}}


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMOKE)


def test_every_query_of_the_library_has_an_oracle():
    assert set(QUERIES) <= set(SQL) and set(SQL) <= set(ALL)


@pytest.mark.skipif(not os.path.isdir(SF_SMOKE), reason="test data missing")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    problems, n, *_ = compare(spark, duck, name, QUERIES[name], SQL[name], SF_SMOKE)
    assert not problems, problems
    assert n > 0


@pytest.mark.skipif(not os.path.isdir(SF_SMOKE), reason="test data missing")
def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 27
    assert df.count() > 0


BLOCKED = """
import importlib.abc, sys
class Blocked(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == "ahocorasick":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), any(n.startswith("op") for n in entry.queries() if n != "orders_flattened"))
"""


def test_core_queries_do_not_need_the_optional_part():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    done = subprocess.run([sys.executable, "-c", BLOCKED], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(QUERIES)), "False"], done.stderr
