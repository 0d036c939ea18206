"""Every registered query gives the same rows as its DuckDB counterpart."""

import pytest

import __spark_entry__ as driver
from lakecheck import oracle, registry
from oracle_compare import connect, difference


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_counterpart():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(registry.queries()) <= set(driver.queries())


@pytest.mark.parametrize("name", registry.queries())
def test_rows(spark, sf_dir, db, name):
    ours = driver.queries()[name](spark, sf_dir).toPandas()
    assert difference(ours, db.execute(driver.oracle_sql()[name]).df()) == ""


def test_entry(spark):
    """The hours share out the cleaned trips of the funnel's last stage."""
    hours = driver.entry(spark).collect()
    assert sum(row.trip_count for row in hours) == 3886
