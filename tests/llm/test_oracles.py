"""The queries that SQL can express, against DuckDB on the same tables."""

import pytest
from oracle_check import compare, duck

from unfurl.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    res = compare(spark, name, QUERIES[name], ORACLE[name], SF, duck(SF))
    assert res["ok"], res


def test_every_operator_has_its_query():
    import __spark_entry__ as E

    names = E.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names
