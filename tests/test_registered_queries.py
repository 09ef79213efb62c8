"""Every registered query against its SQL, and that names line up."""

import compare
import pytest

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


def test_entry_runs(spark):
    assert contract.entry(spark).limit(1).count() == 1


def test_checks_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(name, spark, con, small):
    frame = contract.queries()[name](spark, small)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert frame.count() > 0
    else:
        assert compare.difference(frame, con, sql) is None
