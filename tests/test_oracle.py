"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

from workloads.registry import ORACLE, QUERIES

from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, QUERIES[name], ORACLE[name], SF, con)
    assert res["ok"], res
