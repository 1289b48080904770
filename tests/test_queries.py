"""Every registered query against its DuckDB statement, and the figures of the fixtures."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tests.compare import difference, duckdb_connection
from tilelake import fixtures
from tilelake.operators.quality import clean

DATA = "/root/testdata"
SMALL = f"{DATA}/sf0.001"
# queries of the operators in the llm folder have tests of their own
OWN_TESTS = set(driver.llm_queries.QUERIES) | {"pipeline"} if driver.llm_queries else set()

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the provided tables are not here")


@pytest.fixture(scope="module")
def connection():
    return duckdb_connection(SMALL)


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - OWN_TESTS))
def test_query(spark, connection, name):
    df = driver.queries()[name](spark, SMALL)
    assert difference(df, connection, driver.oracle_sql()[name]) == ""


def test_statements_belong_to_queries():
    assert set(driver.queries()) - set(driver.oracle_sql()) <= OWN_TESTS
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert 0 < len(rows) <= 30
    speeds = [r.avg_download_kbps for r in rows]
    assert speeds == sorted(speeds, reverse=True)


@pytest.mark.parametrize("scale, rows, speed, kept", [("sf0.001", 6000, 3011115419, 4723), ("sf0.01", 60000, 30078978870, 47476)])
def test_fixture_figures(spark, scale, rows, speed, kept):
    tiles = fixtures.tiles(spark, f"{DATA}/{scale}")
    found = tiles.agg(F.count(F.lit(1)), F.sum("avg_d_kbps")).first()
    assert tuple(found) == (rows, speed)
    assert clean(tiles).count() == kept
