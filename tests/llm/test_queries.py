"""The registered queries with an SQL form against it, on the smallest tables."""

import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

duckdb = pytest.importorskip("duckdb")
sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent / "tools"))

from check import TABLES, plain  # noqa: E402

from tideline.llm import queries  # noqa: E402

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")


@pytest.mark.parametrize("name", queries.SQL)
def test_query(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    mine = plain(queries.QUERIES[name](spark, str(FOLDER)).toPandas())
    theirs = plain(db.sql(queries.SQL[name]).df())
    assert list(mine.columns) == list(theirs.columns)
    assert len(mine) == len(theirs) > 0
    assert mine.equals(theirs)


def test_native_operators_run_no_python(spark):
    """Only DataFrame functions in the plans of exact dedup, licences and secrets."""
    for name in ("op3_exact_dedup", "op4_licences", "op8_secrets"):
        df = queries.QUERIES[name](spark, str(FOLDER))
        text = df._jdf.queryExecution().executedPlan().toString()
        operators = re.findall(r"(?:Arrow|Batch|FlatMap|Map|Window|Aggregate|Python)\w*(?:Python|Arrow|Pandas)\w*", text)
        assert not operators, (name, operators)


def test_a_python_operator_would_be_seen(spark):
    """The names that the test above looks for."""
    df = spark.range(3).mapInArrow(lambda batches: batches, "id long")
    both = df.select(F.udf(lambda x: x)("id"))
    text = both._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in text and re.search(r"(?:Batch|Arrow)EvalPython", text)
