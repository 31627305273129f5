"""Every registered query beside its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from conftest import SF
from oracle import compare

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns
    assert df.count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
