"""Aggregates in four steps against plain Python."""

import collections
import random
import statistics
import subprocess
import sys

import pyarrow as pa
import pytest
from conftest import rows_of
from pyspark import cloudpickle

from tideline.operators.accumulators import Average, Quantile, accumulate

SCHEMA = "_k0 string, b long, _value long, result string"


def table(spark, n=4000, parts=7):
    draw = random.Random(3)
    rows = [
        (
            "hot" if draw.random() < 0.4 else draw.choice(["a", "b", None, ""]),
            draw.choice([1, 2, None]),
            None if draw.random() < 0.1 else draw.randrange(0, 100_000),
            "x",
        )
        for _ in range(n)
    ] + [("none", 5, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts), rows


def by_key(rows):
    found = collections.defaultdict(list)
    for a, b, value, _ in rows:
        found[a, b].append(value)
    return found


@pytest.mark.parametrize("held", [1, 3, 100_000])
def test_average(spark, held):
    df, rows = table(spark)
    found = accumulate(df, ["_k0", "b"], "_value", Average(), "mean", held)
    assert found.columns == ["_k0", "b", "mean"]
    want = []
    for key, values in by_key(rows).items():
        known = [value for value in values if value is not None]
        want.append((*key, sum(known) / len(known) if known else None))
    assert rows_of(found) == sorted(want, key=repr)


@pytest.mark.parametrize("share", [0.0, 0.5, 0.99, 1.0])
def test_quantile_is_near_the_true_one(spark, share):
    df, rows = table(spark)
    for row in accumulate(df, ["_k0", "b"], "_value", Quantile(share)).collect():
        known = sorted(v for v in by_key(rows)[row["_k0"], row.b] if v is not None)
        if not known:
            assert row.result is None
            continue
        true = known[max(0, -(-int(share * 1000) * len(known) // 1000) - 1)]
        assert row.result <= true <= row.result * (1 + 2**-5) + 1


def test_merge_does_not_depend_on_order_or_cuts():
    draw = random.Random(4)
    values = [draw.randrange(0, 1 << 40) for _ in range(500)] + [0, 1, None]
    for accumulator in (Average(), Quantile(0.5)):
        whole = accumulator.add(accumulator.create(), pa.array(values, pa.int64()))
        for _ in range(20):
            draw.shuffle(values)
            parts = [values[i : i + 37] for i in range(0, len(values), 37)]
            states = [accumulator.add(accumulator.create(), pa.array(p, pa.int64())) for p in parts]
            total = accumulator.create()
            for state in states:
                total = accumulator.merge(state, total)
            assert total == whole
        known = [value for value in values if value is not None]
    assert Average().finish((len(known), sum(known))) == statistics.fmean(known)


def test_empty_table_and_plan(spark):
    df, _ = table(spark)
    assert accumulate(df.limit(0), ["b"], "_value", Average()).count() == 0
    plan = accumulate(df, ["b"], "_value", Average())._jdf.queryExecution().optimizedPlan().toString()
    # one state per key and task is what is shuffled
    assert plan.count("RepartitionByExpression") == 2 and plan.count("MapInArrow") == 3


def test_own_accumulators_need_no_package_on_the_workers(tmp_path):
    shipped = tmp_path / "shipped"
    shipped.write_bytes(cloudpickle.dumps(Quantile(0.5)))
    run = "import pickle, sys, pyarrow as pa; q = pickle.load(open(sys.argv[1], 'rb'));"
    run += "print(q.finish(q.add(q.create(), pa.array([1, 2, 3]))))"
    done = subprocess.run(
        [sys.executable, "-c", run, str(shipped)], cwd=tmp_path, capture_output=True, text=True, timeout=120
    )
    assert done.stdout.strip() == "2", done.stderr
