"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tideline import plans
from tideline.operators import time_windows
from tideline.operators.skew import lookup_join

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in plans.QUERIES if not n.startswith("stream_")])
def test_no_crossing_joins(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("hourly_top_driver", "struct<ts:timestamp_ntz,user_id:bigint,value:double>"),
        ("ride_count", "struct<user_id:bigint,event_type:string>"),
        ("word_count", "struct<text:string>"),
    ],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    assert f"ReadSchema: {columns}" in plan(entry.queries()[name](spark, FOLDER))


def test_filters_reach_the_scan(spark):
    text = plan(entry.queries()["ride_count"](spark, FOLDER))
    assert "EqualTo(event_type,click)" in text


def test_windows_aggregate_before_the_shuffle(spark):
    rows = spark.range(100).select(F.timestamp_seconds("id").alias("ts"), F.lit(1).alias("d"), "id")
    text = plan(time_windows.hourly_top_driver(rows, "ts", "d", "id"))
    assert text.count("partial_sum") == 1 and text.count("partial_max_by") == 1
    assert text.count("Exchange hashpartitioning") == 2


def test_joins_give_no_broadcast_hint(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
        right = spark.range(7).select(F.col("id").alias("k"), F.lit("x").alias("name"))
        text = plan(lookup_join(left, right, ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 1
    assert "BroadcastHashJoin" not in text
