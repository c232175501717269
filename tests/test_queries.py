"""Every registered query against its SQL in DuckDB."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

import __spark_entry__ as entry  # noqa: E402
from check_queries import canonical, open_tables  # noqa: E402
from lodestar.plans.queries import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def database():
    return open_tables("/root/testdata/sf0.001")


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, database, name):
    got = canonical(entry.queries()[name](spark, sf).toPandas())
    assert got == canonical(database.execute(entry.oracle_sql()[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() == 1500
