"""Every registered stream over whole tables, however the table is cut into micro-batches."""

import os
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

duckdb = pytest.importorskip("duckdb")
sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from check import TABLES, plain  # noqa: E402

from tideline import plans  # noqa: E402
from tideline.plans import streams  # noqa: E402

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")
STREAMS = [name for name in plans.SQL if name.startswith("stream_")]
#: Queries whose arrival order is not that of the events.
BY_ARRIVAL = {
    "stream_car_sort",
    "stream_car_late_ids",
    "stream_window_elements",
    "stream_late_split",
    "stream_late_split_marker",
}


@pytest.fixture(scope="module")
def cut(spark, tmp_path_factory):
    """Tables as folders of four files, which hold consecutive ranges of the arrival order."""
    found = {}
    event = F.col("event_id")
    orders = {
        "events": {False: event, True: event + (event * 7919) % 23},
        "documents": {False: F.col("doc_id")},
        "orders": {False: F.col("o_orderkey")},
        "lineitem": {False: F.col("l_orderkey")},
    }
    for by_arrival in (False, True):
        folder = tmp_path_factory.mktemp("cut")
        for table, keys in orders.items():
            rows = spark.read.parquet(f"{FOLDER}/{table}.parquet")
            order = keys.get(by_arrival, keys[False])
            low, high = rows.agg(F.min(order), F.max(order)).first()
            step = (high - low) // 4 + 1
            for i in range(4):
                part = rows.where((order >= low + i * step) & (order < low + (i + 1) * step))
                file = folder / f"{table}.parquet/part-{i}.parquet"
                file.parent.mkdir(exist_ok=True)
                part.toPandas().to_parquet(file, coerce_timestamps="us", index=False)
                os.utime(file, (1_700_000_000 + 100 * i,) * 2)
        found[by_arrival] = str(folder)
    return found


@pytest.fixture(scope="module")
def expected():
    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return lambda name: plain(db.sql(plans.SQL[name]).df())


@pytest.mark.parametrize("name", STREAMS)
def test_folder_of_files(spark, cut, expected, name, monkeypatch):
    """One file per micro-batch gives the same rows as the SQL form over the whole table."""
    monkeypatch.setattr(streams, "limit", lambda spark, keyed: {"maxFilesPerTrigger": 1})
    found = plain(plans.QUERIES[name](spark, cut[name in BY_ARRIVAL]).toPandas())
    theirs = expected(name)
    assert list(found.columns) == list(theirs.columns)
    assert len(found) == len(theirs) > 0
    assert found.equals(theirs)


def test_windows_of_arrival(spark, cut, monkeypatch):
    """Four files written 100 seconds apart; as a stream, file by file, and as a table."""
    monkeypatch.setattr(streams, "limit", lambda spark, keyed: {"maxFilesPerTrigger": 1})
    found = plain(plans.QUERIES["stream_arrival_window_count"](spark, cut[False]).toPandas())
    table = plain(plans.QUERIES["arrival_window_count"](spark, cut[False]).toPandas())
    assert found.equals(table)
    starts = [pd.Timestamp(1_700_000_000 + 100 * i, unit="s").floor("min") for i in range(4)]
    assert sorted(set(found["window_start"])) == [f"{start:%Y-%m-%d %H:%M:%S.%f}" for start in starts]
    assert sum(map(int, found["n"])) == spark.read.parquet(f"{FOLDER}/events.parquet").count()


def test_large_table_comes_in_bounded_micro_batches(spark, tmp_path):
    """Two files of 40 MB are two micro-batches where a key's rows meet, else one."""
    draw = np.random.default_rng(1)
    (tmp_path / "events.parquet").mkdir()
    for i in range(2):
        values = pd.DataFrame({"value": draw.random(5 << 20)})
        values.to_parquet(tmp_path / f"events.parquet/part-{i}.parquet", index=False)
        assert (tmp_path / f"events.parquet/part-{i}.parquet").stat().st_size > 40 << 20
    for keyed, expected in ((True, 2), (False, 1)):
        rows = streams.stream(spark, str(tmp_path), "events", keyed=keyed)
        checkpoint = tmp_path / f"checkpoint-{keyed}"
        writer = rows.writeStream.format("noop").option("checkpointLocation", str(checkpoint))
        writer.trigger(availableNow=True).start().awaitTermination()
        batches = [x for x in os.listdir(checkpoint / "commits") if x.isdigit()]
        assert len(batches) == expected
    cores = spark.sparkContext.defaultParallelism
    assert streams.limit(spark, False)["maxBytesPerTrigger"] == cores * streams.BYTES_PER_CORE
