"""Every query against its SQL counterpart over whole test tables."""

import os

import pytest

from compare import connect, difference
from oracles.queries import queries
from oracles.sql import oracle_sql

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, FOLDER), connection, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql_counterpart(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_no_catalog_query_is_empty(spark, folder):
    names = [n for n in QUERIES if n[0] in "ms" and n[1].isdigit()]
    assert len(names) > 8 and not [n for n in names if QUERIES[n](spark, folder).isEmpty()]


KEYS = {"dt", "event_date", "event_day", "sub_date", "variation", "variation_id", "country", "day"}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[0] in "rbugvec" and n[1].isdigit()))
def test_reports_have_one_row_per_key(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    keys = [tuple(row[c] for c in row.__fields__ if c in KEYS) for row in rows]
    assert rows and len(set(keys)) == len(keys)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
