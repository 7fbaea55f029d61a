"""Every registered query with an oracle agrees with DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks import compare

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    left = compare.spark_rows(entry.queries()[name](spark, SF))
    assert compare.difference(left, compare.duck_rows(con, ORACLES[name])) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
