"""Every registered query against its SQL form in DuckDB, on the smallest tables."""

import sys
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry  # noqa: E402
from tideline import plans  # noqa: E402
from check import TABLES, plain  # noqa: E402

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", plans.QUERIES)
def test_query(spark, db, name):
    mine = plain(plans.QUERIES[name](spark, str(FOLDER)).toPandas())
    theirs = plain(db.sql(plans.SQL[name]).df())
    assert list(mine.columns) == list(theirs.columns)
    assert len(mine) == len(theirs) > 0
    assert mine.equals(theirs)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
