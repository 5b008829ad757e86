"""Every registered query against its DuckDB twin, on whole tables of the smallest size."""

import pytest
from check_queries import connect, difference

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    found = entry.queries()[name](spark, SF_DIR).toPandas()
    assert len(found.columns) == len(set(found.columns))
    if name in ORACLES:
        assert difference(found, duck.execute(ORACLES[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
