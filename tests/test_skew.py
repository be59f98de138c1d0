"""Sliced windows give the same rows as plain ones, with a key that holds a third of the rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterhouse.operators import asof, history, marts, skew
from meterhouse.operators.history import END, START
from meterhouse.operators.skew import hot_keys, neighbour, number_rows, running_sum, with_slice


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = 1 if i % 3 == 0 else rng.randrange(2, 40)
        # key 1 repeats order values, so ties fall at slice bounds too
        rows.append((key, rng.randrange(0, 400 if key == 1 else 5000), i, rng.randrange(0, 50)))
    return spark.createDataFrame(rows, "k int, t bigint, id bigint, v int").cache()


@pytest.fixture(scope="module")
def hot(skewed):
    found = hot_keys(skewed, ["k"], "t", min_rows=500, slices=16)
    assert [r["k"] for r in found.bounds.collect()] == [1]
    return found


def test_no_hot_keys_below_threshold(skewed):
    assert hot_keys(skewed, ["k"], "t") is None
    assert hot_keys(skewed, ["k"], "t", min_rows=1500) is None


def test_slices_follow_the_order(skewed, hot):
    sliced = with_slice(skewed, ["k"], "t", hot)
    ranges = (
        sliced.where("k = 1").groupBy("_slice").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    ).orderBy("_slice").collect()
    assert len(ranges) > 8
    assert all(a["hi"] < b["lo"] for a, b in zip(ranges, ranges[1:]))
    assert sliced.where("k <> 1 and _slice <> 0").count() == 0


@pytest.mark.parametrize("back", [False, True])
def test_neighbour(skewed, hot, rows_of, back):
    step = F.lag if back else F.lead
    plain = skewed.withColumn("n", step("v").over(Window.partitionBy("k").orderBy("t", "id")))
    sliced = neighbour(
        with_slice(skewed, ["k"], "t", hot), ["k"], ["t", "id"], F.col("v"), "n", hot, back
    )
    assert rows_of(sliced, "k", "t", "id", "v", "n") == rows_of(plain, "k", "t", "id", "v", "n")


def test_running_sum(skewed, hot, rows_of):
    window = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.withColumn("s", F.sum("v").over(window))
    sliced = running_sum(
        with_slice(skewed, ["k"], "t", hot), ["k"], ["t", "id"], F.col("v"), "s", hot
    )
    assert rows_of(sliced, "k", "t", "id", "s") == rows_of(plain, "k", "t", "id", "s")


def test_number_rows(skewed):
    numbered = number_rows(skewed, ["t", "id"], "no").orderBy("no").collect()
    assert [r["no"] for r in numbered] == list(range(1, 3001))
    assert [(r["t"], r["id"]) for r in numbered] == sorted((r["t"], r["id"]) for r in numbered)


@pytest.mark.parametrize("collapse", [False, True])
def test_history_of_hot_keys(skewed, rows_of, collapse):
    changes = skewed.select(
        "k",
        (F.col("v") % 3).alias("state"),
        F.when(F.col("v") == 7, "d").otherwise("u").alias("_op"),
        F.col("t").alias("_ts_ms"),
        F.col("id").alias("_offset"),
    )
    options = {"collapse_unchanged": collapse}
    plain = history.scd2_from_changes(changes, ["k"], **options)
    sliced = history.scd2_from_changes(changes, ["k"], hot_rows=500, **options)
    assert rows_of(plain) == rows_of(sliced)
    assert plain.count() > 1000


def test_as_of_paths_agree(skewed, spark, rows_of):
    changes = skewed.where("id % 4 = 0").select(
        "k",
        F.col("v").alias("limit"),
        F.when(F.col("v") < 5, "d").otherwise("u").alias("_op"),
        F.col("t").alias("_ts_ms"),
        F.col("id").alias("_offset"),
    )
    versions = history.scd2_from_changes(changes, ["k"])
    events = skewed.where("id % 4 <> 0").select("k", "t", "id")
    joined = asof.as_of_broadcast(events, versions, ["k"], "t", ["limit"])
    merged = asof.as_of_merge(events, versions, ["k"], "t", ["limit"])
    sliced = asof.as_of_merge(events, versions, ["k"], "t", ["limit"], hot_rows=500)
    columns = ("k", "t", "id", "limit")
    assert rows_of(joined, *columns) == rows_of(merged, *columns) == rows_of(sliced, *columns)
    assert joined.count() == events.count()
    assert 0 < joined.where("limit is null").count() < events.count()


def test_burndown_of_hot_keys(skewed, rows_of):
    changes = skewed.select(
        "k",
        F.col("v").alias("remaining_budget"),
        F.lit(50).alias("token_budget"),
        F.lit("u").alias("_op"),
        F.col("t").alias("_ts_ms"),
        F.col("id").alias("_offset"),
    )
    versions = history.scd2_from_changes(changes, ["k"])
    plain = marts.budget_burndown(versions, ["k"])
    assert rows_of(plain) == rows_of(marts.budget_burndown(versions, ["k"], hot_rows=200))


def test_null_keys_are_sliced_like_others(spark):
    rows = [(None if i % 3 else 1, i, i % 7) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, at int, v int")
    hot = skew.hot_keys(df, ["k"], "at", min_rows=100)
    sliced = skew.with_slice(df, ["k"], "at", hot)
    assert sliced.groupBy("k").agg(F.countDistinct(skew.SLICE).alias("n")).where("n < 8").isEmpty()
    plain = skew.neighbour(df, ["k"], ["at"], F.col("v"), "next")
    mine = skew.neighbour(sliced, ["k"], ["at"], F.col("v"), "next", hot).drop(skew.SLICE)
    assert sorted(mine.collect(), key=str) == sorted(plain.collect(), key=str)
    sums = skew.running_sum(sliced, ["k"], ["at"], F.col("v"), "sum", hot).drop(skew.SLICE)
    plain = skew.running_sum(df, ["k"], ["at"], F.col("v"), "sum")
    assert sorted(sums.collect(), key=str) == sorted(plain.collect(), key=str)


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_both_as_of_ways_agree_on_dirty_versions(spark, hot_rows):
    versions = [
        (1, 0, 10, "a"), (1, 2, 4, "b"), (1, 6, None, "c"), (1, 6, 8, "d"), (None, 0, None, "n"),
        (2, 5, 5, "e"), (2, 1, None, "f"), (2, 1, None, "g"),
    ]
    history = spark.createDataFrame(versions, f"k int, {START} int, {END} int, v string")
    events = spark.createDataFrame(
        [(k, t) for k in (1, 2, 3, None) for t in range(-1, 13)], "k int, ts int"
    )
    small = asof.as_of_broadcast(events, history, ["k"], "ts", ["v"])
    large = asof.as_of_merge(events, history, ["k"], "ts", ["v"], hot_rows)
    found = sorted(small.collect(), key=str)
    assert found == sorted(large.select(*small.columns).collect(), key=str)
    assert len(found) == 56 and all(r.v is None for r in found if r.k is None)
    assert {r.ts: r.v for r in found if r.k == 1}[5] is None
    assert {r.ts: r.v for r in found if r.k == 1}[9] == "c"
    assert {r.ts: r.v for r in found if r.k == 2}[4] == "g"
