"""Every registered query against its DuckDB equivalent on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import check_oracle

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in check_oracle.TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_duckdb(spark, con, name):
    text, ok = check_oracle.compare(spark, con, FOLDER, name)
    assert ok, text


def test_no_query_compares_all_with_all(spark):
    """Nor picks latest rows without limiting each group before the shuffle."""
    for name in ("show_search_city", "upcoming_shows", "dedupe_latest", "entity_match", "discover"):
        plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
        if name == "dedupe_latest":
            assert "WindowGroupLimit" in plan


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
