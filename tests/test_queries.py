"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    with connect(FOLDER) as connection:
        yield connection


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    assert differences(queries()[name](spark, FOLDER), duck, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0
