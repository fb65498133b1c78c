import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators import pairing, rides, time_windows
from tideline.sources import records
from tideline.sources.lines import queue_options, read_lines

RIDES = """1,START,2013-01-01 00:00:00,1970-01-01 00:00:00,-73.99,40.73,-73.97,40.75,1,11,101
1,END,2013-01-01 00:10:59,2013-01-01 00:00:00,-73.99,40.73,-73.97,40.75,1,11,101
2,START,2013-01-01 00:01:00,1970-01-01 00:00:00,-75.00,40.73,-73.97,40.75,2,12,101
3,START,2013-01-01 00:02:00,1970-01-01 00:00:00,,40.73,-73.97,40.75,2,13,102
4,STOP,2013-01-01 00:02:00,1970-01-01 00:00:00,-73.99,40.73,-73.97,40.75,2,13,102
5,START,2013-01-01 00:02:00"""

FARES = """1,11,101,2013-01-01 00:00:00,CSH,1.50,0,10.00
2,12,101,2013-01-01 00:30:00,CRD,2.25,0,12.00
3,13,102,2013-01-01 00:59:59,CRD,3.00,,9.00
6,14,103,2013-01-01 01:00:00,CRD,0.50,0,8.00
7,15,102,2013-01-01 01:10:00,CRD,,0,8.00
8,15,102,2013-01-01 01:20:00,CRD,1,0,"""

# Connected-car events in arrival order: seq, id, speed, throttle, seconds.
CAR = [
    (1, "e1", 10, 10, 0),
    (2, "e3", 30, 14, 10),
    (3, "e2", 20, 12, 5),
    (4, "e4", 0, 0, 20),
    (5, "e5", 40, 10, 35),
    (6, "e6", 50, 20, 51),
    (7, "e7", 5, 10, 21),
    (8, "e8", 0, 0, 60),
    (9, "e9", 9, 9, 61),
]


def lines(spark, text):
    return spark.createDataFrame([(line,) for line in text.split("\n")], "value string")


def car_line(seq, id, speed, throttle, second):
    tokens = ["x"] * 23
    used = {0: "c1", 1: id, 7: "", 9: speed, 12: throttle, 19: 1, 20: 2.5, 21: 3}
    used[22] = f"2017-01-23T00:{second // 60:02}:{second % 60:02}+0000"
    for place, value in used.items():
        tokens[place] = str(value)
    return ";  ".join(tokens[:10]) + "," + ", ".join(tokens[10:])


def test_rides(spark):
    good, bad = records.parse_rides(lines(spark, RIDES))
    assert good.count() == 4
    assert rows_of(bad, "line", "reason") == sorted(
        [
            ("4,STOP,2013-01-01 00:02:00,1970-01-01 00:00:00,-73.99,40.73,-73.97,40.75,2,13,102", "unknown event kind"),
            ("5,START,2013-01-01 00:02:00", "tokens: 3"),
        ],
        key=repr,
    )
    assert rows_of(rides.ride_count(good)) == [(101, 2), (102, 1)]
    assert rows_of(rides.rides_in_city(good), "ride_id", "is_start") == [(1, False), (1, True)]
    enriched = rides.rides_enriched(good)
    assert enriched.filter("start_lat <> 0").count() == 2
    trips, early = rides.trip_minutes(enriched)
    assert rows_of(trips, "ride_id", "minutes") == [(1, 10)] and early.count() == 0
    assert rows_of(rides.longest_trip(trips), "minutes") == [(10,)]
    third = good.filter("ride_id = 3").first()
    assert third.start_lon == 0.0 and str(third.end_time) == "1970-01-01 00:00:00"


def test_trip_that_ends_before_it_starts_is_a_reject(spark):
    line = "9,END,2013-01-01 00:00:00,2013-01-01 00:05:00,-73.99,40.73,-73.97,40.75,1,11,101"
    good, _ = records.parse_rides(lines(spark, line))
    trips, early = rides.trip_minutes(good)
    assert trips.count() == 0 and early.count() == 1


def test_city_box_edges(spark):
    points = "(-74.05F, 40.5F), (-73.7F, 40.7F), (-73.71F, 41.0F), (float('NaN'), 40.7F), (null, 40.7F)"
    source = spark.sql(f"SELECT * FROM VALUES {points} AS t(lon, lat)")
    from tideline.functions.geo import grid_cell, in_city

    inside = source.select(in_city(F.col("lon"), F.col("lat"))).collect()
    # The 32-bit -74.05 lies just west of the box, as does the 32-bit -73.7 in the east.
    assert [row[0] for row in inside] == [-74.05000305175781 >= -74.05, False, True, False, False]
    cell = spark.sql("SELECT -73.7D AS lon, 41.0D AS lat").select(grid_cell(F.col("lon"), F.col("lat")))
    assert cell.first()[0] in (249, 250)


def test_fares(spark):
    good, bad = records.parse_fares(lines(spark, FARES))
    assert good.count() == 5 and rows_of(bad, "reason") == [("tokens: 7",)]
    tips = time_windows.hourly_tips(good, "start_time", "driver_id", "tip")
    found = rows_of(tips.select(F.hour("window_start"), "driver_id", "tips"))
    assert found == [(0, 101, 3.75), (0, 102, 3.0), (1, 102, 0.0), (1, 103, 0.5)]
    top = time_windows.hourly_top_driver(good, "start_time", "driver_id", "tip")
    assert rows_of(top.select(F.hour("window_start"), "driver_id", "tips")) == [(0, 101, 3.75), (1, 103, 0.5)]
    started, _ = records.parse_rides(lines(spark, RIDES))
    started = started.filter("is_start").select("ride_id", "start_lon")
    assert rows_of(pairing.join_rides_fares(good, started, ["ride_id"]), "ride_id") == [(1,), (2,), (3,)]


def test_top_driver_of_equals_is_the_lowest(spark):
    source = spark.sql("SELECT timestamp'2024-01-01 00:10:00' AS ts, d, 1L AS tip FROM VALUES (7), (3), (5) AS t(d)")
    assert time_windows.hourly_top_driver(source, "ts", "d", "tip").first().d == 3


def test_car_events(spark):
    text = "\n".join(car_line(*event) for event in CAR) + "\n" + "c1;e1,x"
    good, bad = records.parse_car_events(lines(spark, text))
    assert rows_of(bad, "reason") == [("tokens: 3",)]
    found = rows_of(good.select("id", "consumption", "speed", "throttle", F.unix_timestamp("ts") % 86400))
    assert found == sorted(
        ((id, 0.0, float(speed), float(throttle), t) for _, id, speed, throttle, t in CAR), key=repr
    )


def test_pairs(spark):
    source = lines(spark, "a,1\nb, 2\nc,x\nd")
    good, bad = records.parse_pairs(source, T.IntegerType())
    assert rows_of(good) == [("a", 1), ("b", 2)] and rows_of(bad, "reason") == [("tokens: 1",), ("unreadable field",)]
    named, _ = records.parse_pairs(lines(spark, "length 5"), T.IntegerType(), separator=" ")
    assert rows_of(named) == [("length", 5)]
    assert rows_of(records.format_pairs(good, "key", "number")) == [("(a,1)",), ("(b,2)",)]


def test_failfast(spark):
    good, _ = records.parse_fares(lines(spark, FARES), mode="failfast")
    with pytest.raises(Exception, match="bad line"):
        good.collect()


def test_formats_read_back(spark):
    parsed, _ = records.parse_rides(lines(spark, RIDES))
    again, bad = records.parse_rides(records.format_rides(parsed))
    assert rows_of(parsed) == rows_of(again) and bad.count() == 0
    parsed, _ = records.parse_fares(lines(spark, FARES))
    again, bad = records.parse_fares(records.format_fares(parsed))
    assert rows_of(parsed) == rows_of(again) and bad.count() == 0


def test_columns_beside_the_line_stay(spark):
    source = lines(spark, FARES).withColumn("seq", F.lit(3))
    good, bad = records.parse_fares(source)
    assert good.columns[0] == "seq" and bad.columns == ["seq", "line", "reason"]


def test_gzip_lines(spark, tmp_path):
    folder = str(tmp_path / "gz")
    lines(spark, FARES).coalesce(1).write.text(folder, compression="gzip")
    assert read_lines(spark, "text", folder, spread="3").rdd.getNumPartitions() == 3
    assert rows_of(read_lines(spark, "text", folder)) == rows_of(lines(spark, FARES))


def test_queue_options_and_unknown_sources(spark):
    options = queue_options("host:9092", topic="in", group_id="g", startingOffsets="earliest")
    assert options["subscribe"] == "in" and options["kafka.group.id"] == "g"
    assert options["startingOffsets"] == "earliest" and "maxOffsetsPerTrigger" in options
    with pytest.raises(ValueError):
        read_lines(spark, "carrier pigeon", "x")
    with pytest.raises(ValueError):
        read_lines(spark, "socket", "localhost:1")


def test_separators_stand_for_themselves(spark):
    for separator in "|.;$":
        source = lines(spark, f"ab{separator}5\na.b{separator} 6" if separator != "." else "ab.5\nc. 6")
        good, bad = records.parse_pairs(source, T.IntegerType(), separator=separator)
        assert rows_of(good, "number") == [(5,), (6,)] and bad.count() == 0
