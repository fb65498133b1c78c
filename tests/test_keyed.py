import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tideline.operators import control, pairing
from tideline.operators import count_windows as cw
from tideline.operators.running import Fold, chunk_levels, range_chunks, running, with_chunks
from tideline.operators.skew import hot_keys, lookup_join

PAIRS = [(1, 3, 0), (1, 5, 1), (1, 7, 2), (2, 4, 3), (2, 2, 4), (2, 5, 5)]


def pairs(spark, rows=PAIRS):
    return spark.createDataFrame(rows, "key long, value long, seq long")


@pytest.mark.parametrize("hot_rows", [1 << 20, 1])
def test_documented_folds(spark, small_chunks, hot_rows):
    source = pairs(spark)
    averages = cw.count_average(source, "key", ["seq"], "value", hot_rows=hot_rows)
    assert rows_of(averages.select("key", F.round("average", 4))) == [(1, 5.0), (2, 3.6667)]
    sums = cw.running_sum(source, "key", ["seq"], "value", hot_rows)
    assert [r.total for r in sums.orderBy("seq").collect()] == [3, 8, 15, 4, 6, 11]
    texts = cw.running_text(source, "key", ["seq"], "value", hot_rows).orderBy("seq").collect()
    assert [r.text for r in texts] == [
        "Contains: 3",
        "Contains: 3 and 5",
        "Contains: 3 and 5 and 7",
        "Contains: 4",
        "Contains: 4 and 2",
        "Contains: 4 and 2 and 5",
    ]


@pytest.mark.parametrize("hot_rows", [1 << 20, 2])
def test_count_windows(spark, small_chunks, hot_rows):
    source = pairs(spark, [(1, 1, i) for i in range(7)])
    options = {"hot_rows": hot_rows}
    cumulative = cw.count_window_cumulative(source, "key", ["seq"], "value", 3, **options)
    assert rows_of(cumulative, "total") == [(3,), (6,)]
    tumbling = cw.count_window_tumbling(source, "key", ["seq"], "value", 3, **options)
    assert rows_of(tumbling, "block", "total") == [(1, 3), (2, 3)]
    sliding = cw.count_window_sliding(source, "key", ["seq"], "value", 3, 2, **options)
    assert rows_of(sliding, "rn", "total") == [(2, 2), (4, 3), (6, 3)]


def test_sink_batches(spark, small_chunks):
    source = spark.range(45).withColumnRenamed("id", "seq")
    sizes = cw.sink_batches(source, ["seq"], 20).groupBy("batch_no").count()
    assert rows_of(sizes) == [(0, 20), (1, 20), (2, 5)]


def test_running_folds_of_hot_keys_match_brute_force(spark, small_chunks):
    rng = random.Random(7)
    seqs = rng.sample(range(1000), 300)
    rows = [(0 if rng.random() < 0.4 else rng.randrange(1, 30), rng.randrange(-50, 50), s) for s in seqs]
    folds = {
        "total": Fold("sum", F.col("value")),
        "before": Fold("sum", F.col("value"), inclusive=False),
        "top": Fold("max", F.col("value"), inclusive=False),
        "low": Fold("min", F.when(F.col("value") > 0, F.col("value"))),
        "text": Fold("text", F.when(F.col("value") % 2 == 0, F.col("value")).cast("string"), sep="|"),
    }
    for keys, hot_rows, levels in ((["key"], 10, 3), (["key"], 10, 1), (["key"], 1 << 20, 1), ([], 10, 2)):
        chunks = chunk_levels(F.col("seq"), 3, levels)
        found = running(pairs(spark, rows), keys, ["seq"], folds, chunks=chunks, hot_rows=hot_rows)
        expected, state = [], {}
        for key, value, seq in sorted(rows, key=lambda r: r[2]):
            past = state.setdefault(key if keys else None, [])
            total = sum(past) + value
            before = sum(past) if past else None
            top = max(past) if past else None
            past.append(value)
            low = min((v for v in past if v > 0), default=None)
            text = "|".join(str(v) for v in past if v % 2 == 0) or None
            expected.append((key, value, seq, total, before, top, low, text))
        assert rows_of(found) == sorted(expected, key=repr)


def test_a_null_key_is_split_like_any_other(spark, small_chunks):
    source = pairs(spark, [(None, 1, i) for i in range(60)] + [(5, 1, 100)])
    total = running(source, ["key"], ["seq"], {"t": Fold("sum", F.col("value"))}, hot_rows=2)
    assert [r.t for r in total.orderBy("seq").collect()] == [*range(1, 61), 1]
    chunks = with_chunks(source, ["key"], chunk_levels(F.col("seq")), hot_rows=2)
    sizes = chunks.groupBy("key", "_hot", "_chunk0").count()
    assert sizes.agg(F.max("count")).first()[0] == 2
    both = [Fold("max", F.col("seq")), Fold("sum", F.col("value"), inclusive=False)]
    for fold in both:
        found = running(source, ["key"], ["seq"], {"t": fold}, hot_rows=2)
        plain = running(source, ["key"], ["seq"], {"t": fold})
        assert rows_of(found) == rows_of(plain)


def test_sparse_and_repeated_orders(spark):
    """Order values far apart, and one that repeats in half of the rows."""
    sparse = spark.range(500).select(
        F.lit(1).alias("value"), (F.col("id") * (1 << 33)).alias("seq"), F.col("id").alias("n")
    )
    total = {"t": Fold("sum", F.col("value"))}
    found = running(sparse, [], ["seq"], total)
    assert [r.t for r in found.orderBy("seq").collect()] == list(range(1, 501))
    levels = chunk_levels(F.col("seq"))
    assert len(levels) == 2
    met = sparse.select(*[c.alias(f"l{i}") for i, c in enumerate(levels)]).distinct()
    assert met.groupBy("l1").count().agg(F.max("count")).first()[0] <= 128
    repeated = sparse.withColumn("seq", F.when(F.col("n") < 250, 0).otherwise(F.col("n")))
    repeated = repeated.withColumn("k", F.when(F.col("n") % 3 > 0, F.lit("hot")))
    for keys in ([], ["k"]):
        cut = range_chunks(repeated, keys, ["seq", "n"], 8)
        assert cut.groupBy(*keys, "_chunk0").count().agg(F.max("count")).first()[0] <= 150
        assert cut.where("seq = 0").select("_chunk0").distinct().count() > 1
        found = running(cut, keys, ["seq", "n"], total).select("n", *keys, "t")
        plain = running(repeated, keys, ["seq", "n"], total).select("n", *keys, "t")
        assert rows_of(found) == rows_of(plain)


def test_chunks_are_bounded_and_ordered(spark):
    levels = chunk_levels(F.col("id"), 4, 2)
    sizes = spark.range(-1000, 1000).select(levels[0].alias("a"), levels[1].alias("b"))
    assert sizes.groupBy("a").count().agg(F.max("count")).first()[0] == 16
    assert sizes.distinct().groupBy("b").count().agg(F.max("count")).first()[0] == 16


def test_hot_keys_and_lookup_join(spark):
    left = spark.range(100).select(
        F.when(F.col("id") < 60, F.lit(1)).otherwise(F.col("id")).alias("k"), "id"
    )
    left = left.unionByName(spark.createDataFrame([(None, 500)], "k long, id long"))
    right = spark.createDataFrame([(1, "hot"), (70, "cold"), (999, "none")], "k long, name string")
    assert hot_keys(left, ["k"], 10).count() == 1
    for how in ("inner", "left", "left_semi", "left_anti"):
        found = lookup_join(left, right, ["k"], how)
        plain = left.join(right, "k", how)
        assert rows_of(found, *plain.columns) == rows_of(plain)


def test_blocklists(spark):
    words = spark.createDataFrame(
        [("data", 2), ("DROP", 3), ("artisans", 4), ("IGNORE", 5)], "word string, seq long"
    )
    names = spark.createDataFrame([("DROP", 0), ("IGNORE", 1)], "word string, seq long")
    passed = control.blocklist_anti(words, names, ["word"])
    assert rows_of(passed, "word") == [("artisans",), ("data",)]
    early = names.withColumn("seq", F.when(F.col("word") == "DROP", 4).otherwise(0))
    ordered = control.blocklist_ordered(words, early, "word", "seq")
    assert rows_of(ordered, "word") == [("DROP",), ("artisans",), ("data",)]


def test_dynamic_rule(spark, small_chunks):
    rows = [
        (1, None, None, "hello world"),
        (2, "length", 5, None),
        (3, None, None, "hello"),
        (4, None, None, "worlds"),
        (5, "length", 10, None),
        (6, None, None, "worlds"),
        (7, "other", 1, None),
        (8, None, None, "worlds"),
    ]
    source = spark.createDataFrame(rows, "seq long, name string, n long, line string")
    source = source.filter("name IS NULL OR name = 'length'")
    passed = control.dynamic_rule_filter(
        source, F.col("name").isNotNull(), F.col("n"), F.length("line"), ["seq"]
    )
    assert rows_of(passed, "seq", "rule") == [(1, None), (3, 5), (6, 10), (8, 10)]


def brute_slots(rows):
    saved, found = {}, []
    for key, seq, left in sorted(rows, key=lambda r: r[1]):
        slots = saved.setdefault(key, {True: None, False: None})
        partner = slots[not left]
        if partner is None:
            slots[left] = seq
        else:
            slots[not left] = None
            found.append((key, seq, *((seq, partner) if left else (partner, seq))))
    return sorted(found)


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_slots_match_brute_force(spark, small_chunks, seed):
    rng = random.Random(seed)
    seqs = rng.sample(range(2000), 400)
    bias = {k: rng.random() for k in range(12)}
    rows = []
    for seq in seqs:
        key = 0 if rng.random() < 0.4 else rng.randrange(1, 12)
        rows.append((key, seq, rng.random() < bias[key]))
    source = spark.createDataFrame(rows, "key long, seq long, is_left boolean")
    source = source.withColumn("id", F.col("seq"))
    for hot_rows in (1 << 20, 20):
        found = pairing.pair_slots(source, "key", "seq", "is_left", "id", hot_rows)
        flat = found.select("key", "seq", "left_id", "right_id").collect()
        assert sorted(tuple(r) for r in flat) == brute_slots(rows)
