"""Every query equals its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from noticeboard import catalog
from tests.compare import compare, database

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


catalog.load()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF, name) == ""


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert catalog.QUERIES.items() <= entry.queries().items() and catalog.ORACLES.items() <= entry.oracle_sql().items()


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_results_do_not_depend_on_the_session_time_zone(spark, con):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("date_parse", "date_layouts", "iso_render", "epoch_ms", "days_delta", "fresh_filter"):
            assert compare(spark, con, SF, name) == "", name
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
