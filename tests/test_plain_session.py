"""The registered streams in a session that knows nothing of this library, in its own process."""

import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
FOLDER = Path("/root/testdata/sf0.001")

RUN = """
import sys
from pyspark.sql import SparkSession

folder, shared = sys.argv[1:]
spark = (
    SparkSession.builder.master("local[4]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.checkpoint.dir", shared)
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
before = spark.conf.getAll
from tideline import plans
from tideline.session import STATE_STORE, keyed_state

for name, run in plans.QUERIES.items():
    if name.startswith("stream_"):
        try:
            print("ROWS", name, run(spark, folder).count(), flush=True)
        except Exception as error:
            print("ERROR", name, str(error)[:300].replace("\\n", " "), flush=True)
print("OPEN", STATE_STORE not in spark.conf.getAll, flush=True)
spark.conf.set(STATE_STORE, "some.other.Store")
try:
    with keyed_state(spark):
        print("OTHER accepted")
except ValueError as error:
    print("OTHER", error, flush=True)
"""


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")
def test_streams_run_in_a_plain_session(tmp_path):
    from tideline import plans

    done = subprocess.run(
        [sys.executable, "-c", RUN, str(FOLDER), str(tmp_path)],
        cwd=REPO,
        capture_output=True,
        text=True,
        timeout=900,
    )
    lines = [line.split(" ", 2) for line in done.stdout.splitlines()]
    errors = [line for line in lines if line[0] == "ERROR"]
    assert not errors, errors
    rows = {line[1]: int(line[2]) for line in lines if line[0] == "ROWS"}
    assert rows.keys() == {name for name in plans.QUERIES if name.startswith("stream_")}
    assert min(rows.values()) > 0
    assert ["OPEN", "True"] in lines
    assert any(line[0] == "OTHER" and "some.other.Store" in line[2] for line in lines)
