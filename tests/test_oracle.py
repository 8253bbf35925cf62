"""Every registered query against its SQL, whole tables, values and types."""

import pytest
from compare import connect, duck_side, spark_side

import __spark_entry__ as contract
from dimweave.examples import oracles
from dimweave.examples import queries as registered

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(registered.queries()) == set(oracles.oracle_sql())
    assert set(registered.queries()) <= set(contract.queries())
    assert set(oracles.oracle_sql()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_equals_sql(spark, con, name):
    columns, types, rows = spark_side(contract.queries()[name](spark, SF_DIR))
    want_columns, want_types, want_rows = duck_side(con, contract.oracle_sql()[name])
    assert columns == want_columns
    assert types == want_types
    assert rows, "an empty result proves nothing"
    assert rows == want_rows


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
