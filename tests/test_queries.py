"""Every registered query against its SQL, and the contract of the entry file."""

import pytest

import __spark_entry__ as entry
from millrace import plans
from tests import oracle

SQLS = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query_matches_sql(spark, sf, con, name):
    got = oracle.spark_rows(entry.queries()[name](spark, sf))
    assert name in SQLS, "every query has a check"
    assert oracle.same(got, oracle.sql_rows(con, SQLS[name])) is None


def test_entry_has_rows_and_a_schema(spark):
    out = entry.entry(spark)
    assert out.columns == ["day", "event_type", "uv"]
    assert out.count() > 0


def test_every_check_belongs_to_a_query():
    assert set(SQLS) <= set(entry.queries())
