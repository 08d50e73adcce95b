"""Every registered query against its SQL, and the ones without SQL for plain health."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir).toArrow()
    want = duck.sql(ORACLE[name]).to_arrow_table()
    assert differences(got, want) == []
    assert got.num_rows > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["ticker", "date"] and df.count() == 1374
