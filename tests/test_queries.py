"""Every registered query against its SQL."""

import compare
import pytest

import __spark_entry__ as entry
from tidemark.plans import catalog

FOLDER = "/root/testdata/sf0.001"
ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_its_sql(spark, duck, name):
    assert compare.difference(catalog.queries()[name](spark, FOLDER), duck, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(ORACLES)


def test_entry_offers_all_queries():
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(catalog.oracle_sql()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
