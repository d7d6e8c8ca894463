"""Every registered query against its DuckDB statement on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
import oracle

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_query_matches_duckdb(spark, con, name):
    difference = oracle.compare(QUERIES[name](spark, SF), con, SQL[name])
    assert difference is None, difference


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_is_the_line_profile(spark):
    df = entry.entry(spark)
    assert "on_time_3min" in df.columns and df.count() > 0
