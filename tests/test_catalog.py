"""Every registered query against its SQL on the smallest data folder."""

import pytest

import __spark_entry__ as entry
import compare
from adjudika.catalog import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    _, _, problem, _ = compare.compare(spark, duck, name, entry.queries()[name], SQL[name], SF_DIR)
    assert not problem
