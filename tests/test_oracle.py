"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E
from oracle_check import check, duck

SF = "/root/testdata/sf0.01"
ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    ok, n, _, msg = check(spark, con, name, QUERIES[name], ORACLE[name], SF)
    assert ok, f"{name}: {msg}"


def test_registry_consistent():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 99


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["prefix", "n_rows", "n_shards", "n_images", "n_geo"]
    assert df.count() > 0
