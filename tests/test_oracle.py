"""Every registered query against its SQL on the driver's tables."""

import oracle
import pytest

import __spark_entry__ as contract

QUERIES = contract.queries()
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    frame = QUERIES[name](spark, sf_dir)
    if name in SQL:
        assert oracle.difference(frame, duck, SQL[name]) is None
    else:
        assert frame.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    frame = contract.entry(spark)
    assert "Timeline Evaluation" in frame.columns
    assert frame.limit(1).count() == 1
