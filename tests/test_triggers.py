"""Windows that a trigger closes, against a loop over the rows."""

import random

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tideline.operators import count_windows as cw
from tideline.operators import triggers

SCHEMA = "user string, at long, symbol int, _row string, window string"


def table(spark, n=3000):
    draw = random.Random(8)
    rows = [
        (
            "hot" if draw.random() < 0.5 else draw.choice(["a", "b", None, ""]),
            i,
            draw.choice([0, 0, 0, 1, 2, None]),
            "x",
            None,
        )
        for i in range(n)
    ]
    draw.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5), rows


def by_hand(rows, trigger):
    state, number, found = {}, {}, []
    for user, at, symbol, *_ in sorted(rows, key=lambda row: row[1]):
        s, n = state.get(user, 0), number.get(user, 0)
        closes = symbol is not None and bool(trigger.closes[symbol][s])
        found.append((user, at, n, closes))
        state[user] = s if symbol is None else trigger.after[symbol][s]
        number[user] = n + closes
    return sorted(found, key=repr)


def drawn(states=5, symbols=3):
    draw = np.random.default_rng(2)
    after = draw.integers(0, states, (symbols, states)).tolist()
    return triggers.Trigger(after, (draw.random((symbols, states)) < 0.3).tolist())


@pytest.mark.parametrize("shuffles", [1, 4, 40])
def test_any_automaton_over_a_hot_key(spark, shuffles):
    df, rows = table(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffles))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        trigger = drawn()
        found = triggers.windows(df, ["user"], ["at"], F.col("symbol"), trigger)
        assert found.columns == [*df.columns, "window_no", "closes"]
        assert rows_of(found, "user", "at", "window_no", "closes") == by_hand(rows, trigger)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_count_trigger_is_the_count_window(spark):
    df, _ = table(spark)
    rows = df.where("user is not null")
    trigger = triggers.count_or_stop(3)
    found = triggers.windows(rows, ["user"], ["at"], F.lit(0), trigger)
    sums = found.groupBy("user", "window_no").agg(F.sum("at").alias("total"), F.max("closes").alias("full"))
    want = cw.count_window_tumbling(rows, "user", ["at"], "at", 3)
    assert rows_of(sums.where("full"), "user", "total") == rows_of(want, "user", "total")


def test_empty_table_and_small_batches(spark):
    df, rows = table(spark, 400)
    trigger = triggers.count_or_stop(4)
    assert triggers.windows(df.limit(0), ["user"], ["at"], F.col("symbol"), trigger).count() == 0
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        symbol = F.when(F.col("symbol") > 1, 0).otherwise(F.col("symbol"))
        found = triggers.windows(df, ["user"], ["at"], symbol, trigger)
        cut = [(user, at, 0 if s == 2 else s) for user, at, s, *_ in rows]
        assert rows_of(found, "user", "at", "window_no", "closes") == by_hand(cut, trigger)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
