"""Every registered query against its SQL twin on the smallest scale."""

import pytest

import oracle
from lexiloom import queries as registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, small, name):
    problem, rows, _, _ = oracle.compare(spark, con, name, QUERIES[name], SQL.get(name), small)
    assert problem is None, problem
    assert rows >= 0


def test_entry_runs(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0
    assert "reconstructed_text" in df.columns
