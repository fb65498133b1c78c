"""Folds over micro-batches: against the batch forms, with hot and null keys, restarts and reruns."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tideline.operators import control, pairing
from tideline.operators import count_windows as cw
from tideline.streaming import folds

SCHEMA = "key string, seq long, value long, is_left boolean"


@pytest.fixture
def source(spark):
    """A hot key, small keys, a null key, null values."""
    draw = random.Random(5)
    rows = []
    for seq in range(240):
        key = draw.choice(["hot", "hot", "hot", "a", "b", None])
        rows.append((key, seq, draw.choice([None, 1, 2, 3, 50]), draw.random() < 0.5))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def in_batches(df, write, folder, cuts):
    """Micro-batches between the cuts, the last one run twice as after a failure."""
    bounds = [0, *cuts, 1 << 40]
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        write(df.filter((F.col("seq") >= low) & (F.col("seq") < high)), i)
    write(df.filter(F.col("seq") >= bounds[-2]), len(cuts))
    return df.sparkSession.read.parquet(f"{folder}/out").drop("batch")


CUTS = [[], [100], [1, 2, 90, 90, 239]]


@pytest.mark.parametrize("cuts", CUTS)
@pytest.mark.parametrize("hot_rows", [1 << 20, 20])
def test_running(spark, tmp_path, small_chunks, source, cuts, hot_rows):
    folder = str(tmp_path)
    write = folds.running_writer(folder, "key", ["seq"], "value", True, hot_rows)
    found = in_batches(source, write, folder, cuts)
    sums = cw.running_sum(source, "key", ["seq"], "value")
    assert rows_of(found, "key", "seq", "total") == rows_of(sums, "key", "seq", "total")
    texts = cw.running_text(source, "key", ["seq"], "value")
    assert rows_of(found, "key", "seq", "text") == rows_of(texts, "key", "seq", "text")


@pytest.mark.parametrize("cuts", CUTS)
def test_counted(spark, tmp_path, small_chunks, source, cuts):
    def run(name, every, size):
        folder = str(tmp_path / name)
        return in_batches(source, folds.counted_writer(folder, "key", ["seq"], "value", every, size, 20), folder, cuts)

    expected = cw.count_window_cumulative(source, "key", ["seq"], "value", 3)
    assert rows_of(run("all", 3, None), "key", "rn", "total") == rows_of(expected, "key", "rn", "total")
    expected = cw.count_window_sliding(source, "key", ["seq"], "value", 3, 2)
    assert rows_of(run("some", 2, 3), "key", "rn", "total") == rows_of(expected, "key", "rn", "total")
    blocks = run("blocks", 3, 3)
    blocks = blocks.select("key", F.expr("rn div 3").alias("block"), (F.col("total") / F.col("given")).alias("average"))
    assert rows_of(blocks) == rows_of(cw.count_average(source, "key", ["seq"], "value"))


@pytest.mark.parametrize("cuts", CUTS)
def test_slots(spark, tmp_path, small_chunks, source, cuts):
    folder = str(tmp_path)
    write = folds.slots_writer(folder, "key", "seq", "is_left", "value", 20)
    expected = pairing.pair_slots(source, "key", "seq", "is_left", "value")
    assert rows_of(in_batches(source, write, folder, cuts)) == rows_of(expected)


@pytest.mark.parametrize("cuts", CUTS)
def test_blocklist(spark, tmp_path, source, cuts):
    folder = str(tmp_path)
    is_control = F.col("value") == 50
    found = in_batches(source, folds.blocklist_writer(folder, is_control, "key", "seq"), folder, cuts)
    named = F.coalesce(is_control, F.lit(False))
    expected = control.blocklist_ordered(source.filter(~named), source.filter(named), "key", "seq")
    assert rows_of(found, "key", "seq") == rows_of(expected, "key", "seq")


def rules_by_hand(rows):
    rules, passed = {}, []
    for key, seq, value, is_control in sorted(rows, key=lambda row: row[1]):
        if is_control:
            rules[key] = value
            continue
        limit = rules.get(key) if key is not None else None
        if limit is None or (value is not None and value <= limit):
            passed.append((key, seq, value, limit))
    return sorted(passed, key=repr)


@pytest.mark.parametrize("cuts", CUTS)
def test_named_rules(spark, tmp_path, small_chunks, source, cuts):
    """Many rules in force at once, rules set to null, rows without a name, a hot name."""
    expected = rules_by_hand([tuple(row) for row in source.collect()])
    value = F.col("value")
    for hot_rows in (1 << 20, 20):
        found = control.rules_asof(source, F.col("is_left"), "key", value, value, ["seq"], hot_rows)
        assert rows_of(found, "key", "seq", "value", "rule") == expected
    folder = str(tmp_path)
    write = folds.rules_writer(folder, F.col("is_left"), "key", value, value, ["seq"], 20)
    assert rows_of(in_batches(source, write, folder, cuts), "key", "seq", "value", "rule") == expected


@pytest.mark.parametrize("once", [False, True])
@pytest.mark.parametrize("cuts", CUTS)
def test_matched_rows_are_forgotten(spark, tmp_path, cuts, once):
    """Whichever side comes first; what has matched is in no state."""
    draw = random.Random(7)
    rows = [(i, "left", i * 10) for i in range(80)] + [(i, "right", i) for i in range(60, 140)]
    if not once:
        rows += [(i, "right", -i) for i in range(0, 140, 7)]
    draw.shuffle(rows)
    table = [(k, side == "left", v if side == "left" else None, None if side == "left" else v, i)
             for i, (k, side, v) in enumerate(rows)]
    df = spark.createDataFrame(table, "id long, is_ride boolean, ride long, fare long, seq long")
    folder = str(tmp_path)
    write = folds.matched_writer(folder, "is_ride", "id", ["ride"], ["fare"], once)
    found = in_batches(df, write, folder, cuts)
    fares = [(k, v) for k, side, v in rows if side == "right"]
    assert rows_of(found, "id", "ride", "fare") == sorted(((k, k * 10, v) for k, v in fares if k < 80), key=repr)
    waiting = spark.read.parquet(f"{folder}/waiting/batch={len(cuts)}")
    assert sorted(row.id for row in waiting.collect()) == sorted(k for k, _ in fares if k >= 80)
    if once:
        left = spark.read.parquet(f"{folder}/left/batch={len(cuts)}")
        assert sorted(row.id for row in left.collect()) == list(range(60))


def test_one_key_of_one_file_spans_many_tasks(spark, tmp_path):
    """All rows of a micro-batch have one key; they are folded in chunks of 256 arrivals."""
    rows = spark.range(0, 20_000, 1, 1).select(
        F.lit("hot").alias("key"), F.col("id").alias("seq"), F.lit(1).cast("long").alias("value")
    )
    folder = str(tmp_path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    from tideline.operators import running as running_module

    bits, running_module.CHUNK_BITS = running_module.CHUNK_BITS, 8
    try:
        folds.running_writer(folder, "key", ["seq"], "value", hot_rows=1000)(rows, 0)
    finally:
        running_module.CHUNK_BITS = bits
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = spark.read.parquet(f"{folder}/out").withColumn("file", F.input_file_name())
    counts = [row["count"] for row in found.groupBy("file").count().collect()]
    assert sum(counts) == 20_000 and len(counts) >= 3 and max(counts) < 14_000
    assert found.filter("total <> seq + 1").isEmpty()
    state = spark.read.parquet(f"{folder}/state/batch=0").collect()
    assert [(row.key, row.seq, row.total) for row in state] == [("hot", 19_999, 20_000)]
