"""Every registered query against its SQL on the whole tables."""

import os

import pytest
from compare import connect, differences
from conftest import SF_DIR

import __spark_entry__ as registry
from lineside.plans.catalog import QUERIES
from lineside.plans.oracles import ORACLES

DIR = os.environ.get("ORACLE_SF_DIR", SF_DIR)
ROWS_ONLY = {"refresh_history"}


@pytest.fixture(scope="module")
def con():
    return connect(DIR)


def test_every_query_has_an_oracle_but_for_those_without_a_table_form():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_no_oracle_is_empty(con, name):
    assert con.sql(ORACLES[name]).limit(1).fetchall()


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches(spark, con, name):
    assert differences(registry.queries()[name](spark, DIR), con, registry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_has_rows(spark, name):
    assert registry.queries()[name](spark, DIR).count() > 0
