"""Every registered query against its SQL, and the driver contract."""

import pytest
from compare import check, connect

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def tables(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_rows_as_sql(spark, tables, sf_dir, name):
    check(spark, tables, contract.queries()[name], contract.oracle_sql()[name], sf_dir)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["window_start", "window_end", "status", "count"]
    assert df.count() > 0
