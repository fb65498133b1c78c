"""Line sources: text files (gzip included), sockets and message queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(
    spark: SparkSession, kind: str, location: str, *, stream: bool = False, **options: str
) -> DataFrame:
    """Lines as a one-column table ``value``.

    kind     location
    text     path, folder or glob; ``.gz`` files are unpacked by Spark
    socket   host:port (stream only)
    queue    bootstrap servers; options ``topic``, and ``group_id`` if the consumer has one

    A gzip file can only be read by one task, so land many files rather than a large one; the
    option ``spread`` (a number of tasks) distributes the lines of few large files right after
    the read. ``max_files`` and ``max_rows`` bound a micro-batch.
    """
    if kind == "text":
        spread = options.pop("spread", None)
        reader = spark.readStream if stream else spark.read
        if stream:
            reader = reader.option("maxFilesPerTrigger", options.pop("max_files", "1000"))
        lines = reader.options(**options).text(location)
        return lines.repartition(int(spread)) if spread else lines
    if kind == "socket":
        if not stream:
            raise ValueError("a socket can only be read as a stream")
        host, port = location.rsplit(":", 1)
        return spark.readStream.format("socket").option("host", host).option("port", port).load()
    if kind == "queue":
        reader = (spark.readStream if stream else spark.read).format("kafka")
        reader = reader.options(**queue_options(location, stream=stream, **options))
        return reader.load().select(F.col("value").cast("string").alias("value"))
    raise ValueError(f"unknown line source: {kind}")


def queue_options(
    servers: str, *, topic: str, stream: bool = True, **options: str
) -> dict[str, str]:
    """Options of the message-queue reader."""
    known = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if "group_id" in options:
        known["kafka.group.id"] = options.pop("group_id")
    if stream:
        known["maxOffsetsPerTrigger"] = options.pop("max_rows", "1000000")
    return known | options


def with_arrival(rows: DataFrame, name: str = "arrived") -> DataFrame:
    """Add when each row arrived: the time at which its file was written. Unlike the clock at which
    a job happens to read, it is the same when files are read again, in batch or as a stream."""
    return rows.withColumn(name, F.col("_metadata.file_modification_time"))
