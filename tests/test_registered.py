"""Every registered query against its SQL on the smallest driver tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
import oracle_compare

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in registered.queries().items() if name in registered.REGISTERED}
SQL = {name: sql for name, sql in registered.oracle_sql().items() if name in registered.REGISTERED}


@pytest.fixture(scope="module")
def duck():
    return oracle_compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    assert oracle_compare.differences(QUERIES[name](spark, SF_DIR), duck, SQL[name]) == []


def test_entry(spark):
    assert registered.entry(spark).count() == 1500


@pytest.mark.parametrize("name", ["incremental_delta", "incremental_lookback", "revenue_by_region", "scd2_check"])
def test_results_do_not_depend_on_the_session_zone(spark, duck, name):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert oracle_compare.differences(QUERIES[name](spark, SF_DIR), duck, SQL[name]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
