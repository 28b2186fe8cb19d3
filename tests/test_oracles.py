"""Every registered query with a SQL twin gives the same columns, types and rows as DuckDB."""

import pytest

import __spark_entry__ as entry_points
from tests.oracle_check import compare, duck_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_matches_sql(spark, duck, name):
    query = entry_points.queries()[name]
    problems = [p for p in compare(spark, duck, name, query, entry_points.oracle_sql()[name], SF) if p != "both sides are empty"]
    assert not problems


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_names_agree():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
