"""Registered queries against their SQL, and what every one of them promises."""

import compare
import pytest

from tidemark.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    assert compare.difference(queries.QUERIES[name](spark, FOLDER), compare.connect(FOLDER), queries.ORACLES[name]) is None


def test_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
