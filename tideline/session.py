"""Session helpers: a local session for tests and benches, and the shared work folder."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cpus: int | str = 8, app: str = "tideline", **conf: str) -> SparkSession:
    """A single-machine session. On a cluster, use the session the cluster gives."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config(STATE_STORE, ROCKSDB)
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Every window and text format here is defined on UTC clock time."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _state_store(spark: SparkSession) -> str | None:
    """The state store that somebody has chosen, for the session or the application. One that
    cannot hold several states of a key is an error."""
    chosen = spark.conf.getAll.get(STATE_STORE)
    if chosen not in (None, ROCKSDB):
        raise ValueError(f"keyed streams need {STATE_STORE}={ROCKSDB}, but it is set to {chosen}")
    return chosen


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in the RocksDB store, as keyed streams must. The
    option is set only where the session leaves it open, and is open again afterwards: a started
    stream works on its own copy of the session's options."""
    if _state_store(spark):
        yield
        return
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE)


def start_keyed(writer: DataStreamWriter) -> StreamingQuery:
    """Start a stream that may hold keyed state, in any session."""
    with keyed_state(writer._spark):
        return writer.start()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Only where that is unset and Spark runs
    on one machine is a temporary folder made, and remembered in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tideline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/tideline/{purpose}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut, in the checkpoint folder that all executors share.

    Its partitions and their row order stay as they are for every later job, whatever
    executors are lost.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(work_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library made, in whatever store it lies."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.delete(place, True)


def ship_by_value(module: str) -> None:
    """Send a module's functions and classes to the Python workers with the task, so that
    executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
