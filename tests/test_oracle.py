"""Every registered query against its SQL."""

import pytest

from heronry.plans import all_oracles, all_queries
from tests.compare import oracle_connection, oracle_rows, schemas, spark_rows

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_connection(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    got = spark_rows(df)
    if name not in ORACLES:
        assert got
        return
    ours, theirs = schemas(df, con, ORACLES[name])
    assert ours == theirs
    expected = oracle_rows(con, ORACLES[name])
    assert len(got) == len(expected)
    assert got == expected
