"""Every registered query against its SQL, on whole tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
SQL = contract.oracle_sql()
# Whole grid searches, of up to some minutes each; ``test_classify`` holds the search itself
# against Spark's. TEST_SEARCHES=1 runs them here as well.
SEARCHES = {"cv_grid", "best_params", "tuned_vs_base", "tvs_grid", "light_vs_heavy", "tvs_text_grid", "draft_search"}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(table):
    """Rows with columns by name, values spelled the same whichever engine made them."""
    def spelled(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return "null"
        return repr(value) if isinstance(value, float) else str(value)
    return sorted(tuple(spelled(row[c]) for c in sorted(table.column_names)) for row in table.to_pylist())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, tables, name):
    if name in SEARCHES and not os.environ.get("TEST_SEARCHES"):
        pytest.skip("set TEST_SEARCHES=1")
    result = contract.queries()[name](spark, FOLDER).toArrow()
    if name not in SQL:
        assert result.num_rows > 0
        return
    expected = tables.execute(SQL[name]).to_arrow_table()
    assert sorted(result.column_names) == sorted(expected.column_names)
    assert comparable(result) == comparable(expected)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["category", "rank", "term", "chi2"]
    assert result.count() > 0
