"""Every query of the library's own that has an SQL counterpart, on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
from compare import bag

from martwright.catalog.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in sorted(os.listdir(SF_DIR)):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    found = bag([tuple(r) for r in frame.collect()], frame.columns)
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(frame.columns) == sorted(columns)
    assert found == bag(answer.fetchall(), columns)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_queries_without_sql_are_few():
    assert set(QUERIES) - set(ORACLES) == {"landed_file_preview"}
