"""Every registered query against its SQL on the same tables."""

import pytest

import __spark_entry__ as spark_entry
import oracles
from check import connect, spark_rows, sql_rows
from conftest import CHECKED, SMALL
from tillwright import registry


@pytest.fixture(scope="module", params=[SMALL])
def tables(request):
    return request.param, connect(request.param)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracles.texts())
    assert set(registry.queries()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_matches_sql(spark, tables, name):
    root, con = tables
    columns, rows = spark_rows(spark_entry.queries()[name](spark, root))
    want_columns, want_rows = sql_rows(con, spark_entry.oracle_sql()[name])
    assert columns == want_columns
    assert rows == want_rows


@pytest.mark.parametrize("name", ["daily_sales_summary", "realtime_snapshots_redelivered", "stream_upsert"])
def test_matches_sql_at_more_rows(spark, name):
    got = spark_rows(spark_entry.queries()[name](spark, CHECKED))
    assert got == sql_rows(connect(CHECKED), spark_entry.oracle_sql()[name])


def test_entry(spark):
    assert spark_entry.entry(spark).limit(1).count() == 1
