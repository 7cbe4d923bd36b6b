"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


SHARD_QUERIES = sorted(n for n in E.queries() if n[0] == "q" and n[1:3].isdigit())


@pytest.mark.parametrize("name", SHARD_QUERIES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    ok, msg = compare(df, con, E.oracle_sql()[name])
    assert ok, msg


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_orderstatus", "n"]


def test_every_query_has_an_oracle():
    assert set(SHARD_QUERIES) <= set(E.oracle_sql())
    assert all(callable(f) for f in E.queries().values())
