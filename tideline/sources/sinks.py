"""Sinks: console, files, memory and message queue. Rows handed over in batches are in
``streaming/batches.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def write_stream(
    df: DataFrame,
    kind: str,
    *,
    checkpoint: str,
    target: str | None = None,
    mode: str = "append",
    topic: str | None = None,
    every: str | None = None,
) -> DataStreamWriter:
    """A prepared stream writer; call ``start`` on it.

    kind     target
    console  -
    memory   table name
    parquet  folder
    queue    bootstrap servers; ``df`` has a string column ``value``, ``topic`` is needed

    Without ``every`` (a trigger interval) the stream takes what there is and ends.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if kind == "console":
        return writer.format("console").option("truncate", "false")
    if kind == "memory":
        return writer.format("memory").queryName(target)
    if kind == "parquet":
        return writer.format("parquet").option("path", target)
    if kind == "queue":
        options = {"kafka.bootstrap.servers": target, "topic": topic}
        return writer.format("kafka").options(**options)
    raise ValueError(f"unknown sink: {kind}")
