"""SCD edge cases: deletes, gaps, ties, tombstones, late changes, untracked columns."""

import pytest
from pyspark.sql import functions as F

from meterhouse.functions.schemas import USER_IMAGE, envelope, names_of
from meterhouse.operators import history, quality, shape
from meterhouse.streaming.events import CheckpointMismatch
from meterhouse.streaming.history import ChangeHistory

CHANGES = "k int, v string, _op string, _ts_ms bigint, _part int, _offset bigint"


def feed(spark, rows):
    return spark.createDataFrame(
        [(k, v, op, ts, 0, n) for n, (k, v, op, ts) in enumerate(rows)], CHANGES
    )


def versions(df):
    rows = df.select("k", "v", "__START_AT", "__END_AT").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0], r[2]))


def test_update_closes_and_delete_opens_nothing(spark):
    changes = feed(spark, [(1, "a", "c", 10), (1, "b", "u", 20), (1, "b", "d", 30), (1, "c", "c", 50)])
    assert versions(history.scd2_from_changes(changes, ["k"])) == [
        (1, "a", 10, 20),
        (1, "b", 20, 30),
        (1, "c", 50, None),
    ]


def test_arrival_order_does_not_matter(spark):
    rows = [(1, "c", "u", 30), (1, "a", "c", 10), (1, "b", "u", 20)]
    assert versions(history.scd2_from_changes(feed(spark, rows), ["k"])) == [
        (1, "a", 10, 20),
        (1, "b", 20, 30),
        (1, "c", 30, None),
    ]


def test_ties_are_settled_by_offset(spark):
    rows = [(1, "a", "c", 10), (1, "b", "u", 10), (1, "c", "u", 10), (2, "x", "c", 5), (2, "x", "d", 5)]
    assert versions(history.scd2_from_changes(feed(spark, rows), ["k"])) == [(1, "c", 10, None)]


def test_collapse_unchanged(spark):
    rows = [(1, "a", "c", 10), (1, "a", "u", 20), (1, "a", "d", 30), (1, "a", "c", 40), (1, "b", "u", 50)]
    assert versions(history.scd2_from_changes(feed(spark, rows), ["k"], collapse_unchanged=True)) == [
        (1, "a", 10, 30),
        (1, "a", 40, 50),
        (1, "b", 50, None),
    ]


def test_scd1_drops_deleted_keys(spark):
    rows = [(1, "a", "c", 10), (1, "b", "u", 20), (2, "x", "c", 10), (2, "x", "d", 20)]
    assert [tuple(r) for r in history.scd1_from_changes(feed(spark, rows), ["k"]).collect()] == [(1, "b")]


def test_three_quick_updates(spark):
    """A snapshot sees the last state only, the log all of them."""
    log = history.scd2_from_changes(
        feed(spark, [(1, "1000", "r", 0), (1, "4000", "u", 10), (1, "3000", "u", 20), (1, "2000", "u", 30)]),
        ["k"],
    )
    snaps = spark.createDataFrame([(1, "1000", 0), (1, "2000", 40)], "k int, v string, n int")
    seen = history.scd2_from_snapshots(snaps, ["k"], "n")
    assert versions(seen) == [(1, "1000", 0, 40), (1, "2000", 40, None)]
    lost = history.lost_versions(log, seen, ["k"], ["v"]).collect()
    assert sorted(r["v"] for r in lost) == ["3000", "4000"]


def test_snapshot_gap_reopens(spark):
    rows = [(1, "a", 1), (2, "x", 1), (2, "x", 2), (1, "a", 3), (2, "x", 3), (1, "a", 4)]
    snaps = spark.createDataFrame(rows, "k int, v string, n int")
    assert versions(history.scd2_from_snapshots(snaps, ["k"], "n")) == [
        (1, "a", 1, 2),
        (1, "a", 3, None),
        (2, "x", 1, 4),
    ]


def test_null_is_a_value(spark):
    snaps = spark.createDataFrame(
        [(1, None, 1), (1, None, 2), (1, "a", 3), (1, None, 4)], "k int, v string, n int"
    )
    assert versions(history.scd2_from_snapshots(snaps, ["k"], "n")) == [
        (1, None, 1, 3),
        (1, "a", 3, 4),
        (1, None, 4, None),
    ]


def test_untracked_column_takes_newest_value(spark):
    snaps = spark.createDataFrame(
        [(1, "a", 100, 1), (1, "a", 200, 2), (1, "b", 300, 3)], "k int, v string, at int, n int"
    )
    rows = history.scd2_from_snapshots(snaps, ["k"], "n", track_except=["at"]).orderBy("__START_AT")
    assert [(r["v"], r["at"], r["__START_AT"], r["__END_AT"]) for r in rows.collect()] == [
        ("a", 200, 1, 3),
        ("b", 300, 3, None),
    ]


def test_apply_snapshot_equals_full_history(spark, tables, tmp_path):
    snaps = tables.user_snapshots()
    full = history.scd2_from_snapshots(snaps, ["user_id"], "snap_year")
    current, closed = None, None
    for year in range(1995, 2002):
        snap = snaps.where(F.col("snap_year") == year).drop("snap_year")
        if current is None:
            current = snap.limit(0).select(
                "*", F.lit(0).alias("__START_AT"), F.lit(None).cast("int").alias("__END_AT")
            )
        opened, done = history.scd2_apply_snapshot(current, snap, ["user_id"], F.lit(year))
        path = str(tmp_path / f"{year}")
        opened.write.parquet(path + "-open")
        done.write.parquet(path + "-closed")
        current = spark.read.parquet(path + "-open")
        part = spark.read.parquet(path + "-closed")
        closed = part if closed is None else closed.unionByName(part)
    both = current.unionByName(closed).select(full.columns)
    assert both.exceptAll(full).count() == 0 and full.exceptAll(both).count() == 0


def test_intervals_never_overlap(tables):
    changes = tables.user_changes().select(
        "user_id",
        "plan_id",
        F.col("op").alias("_op"),
        F.unix_millis("changed_at").alias("_ts_ms"),
        F.col("offset_").alias("_offset"),
    )
    full = history.scd2_from_changes(changes, ["user_id"])
    a, b = full.alias("a"), full.alias("b")
    overlap = a.join(
        b,
        (F.col("a.user_id") == F.col("b.user_id"))
        & (F.col("a.__START_AT") < F.col("b.__START_AT"))
        & (F.col("a.__END_AT").isNull() | (F.col("a.__END_AT") > F.col("b.__START_AT"))),
    )
    assert overlap.count() == 0
    current = history.scd2_current(full).select("user_id", "plan_id")
    last = history.scd1_from_changes(changes, ["user_id"])
    assert current.exceptAll(last).count() == 0 and last.exceptAll(current).count() == 0


def message(spark, rows):
    return spark.createDataFrame(
        [("t.users", 0, n, v) for n, v in enumerate(rows)],
        "topic string, partition int, offset bigint, _value string",
    )


IMAGE = '{"user_id":1,"user_name":"a","plan_id":2,"token_budget":10,"remaining_budget":9,"is_active":1}'


def test_flatten_takes_old_image_of_a_delete_and_skips_tombstones(spark):
    raw = message(
        spark,
        [
            f'{{"before":null,"after":{IMAGE},"op":"c","ts_ms":5}}',
            f'{{"before":{IMAGE},"after":null,"op":"d","ts_ms":7}}',
            None,
        ],
    )
    rows = shape.flatten_changes(raw, "t.users", envelope(USER_IMAGE), names_of(USER_IMAGE)).collect()
    assert [(r["user_id"], r["is_active"], r["_op"], r["_ts_ms"]) for r in rows] == [
        (1, 1, "c", 5),
        (1, 1, "d", 7),
    ]


def test_envelope_health_finds_wrong_types(spark):
    wrong = IMAGE.replace('"is_active":1', '"is_active":true')
    raw = message(
        spark,
        [
            f'{{"before":null,"after":{IMAGE},"op":"c","ts_ms":5}}',
            f'{{"before":null,"after":{wrong},"op":"c","ts_ms":5}}',
            '{"after":{"user_name":"x"},"op":"u","ts_ms":6}',
            "garbage",
            None,
        ],
    )
    parsed = shape.parse_changes(raw, "t.users", envelope(USER_IMAGE))
    row = quality.envelope_health(parsed, ["user_id"]).first().asDict()
    assert row == {
        "topic": "t.users",
        "messages": 5,
        "tombstones": 1,
        "unparsed": 1,
        "missing_key": 1,
        "null_fields": 1,
    }


@pytest.mark.parametrize("replays", [1, 2])
def test_change_history_survives_replayed_batches(spark, tmp_path, replays):
    batches = [
        [(1, "a", "c", 10), (2, "x", "c", 10), (1, "c", "u", 30)],
        [(1, "b", "u", 20), (3, "n", "c", 15)],
        [(2, "x", "d", 40)],
    ]
    store = ChangeHistory(str(tmp_path / "store"), ["k"])
    offset = 0
    everything = []
    for n, rows in enumerate(batches):
        part = [(k, v, op, ts, 0, offset + i) for i, (k, v, op, ts) in enumerate(rows)]
        offset += len(rows)
        everything += part
        for _ in range(replays):
            store.apply(spark.createDataFrame(part, CHANGES), n)
    full = history.scd2_from_changes(spark.createDataFrame(everything, CHANGES), ["k"])
    assert versions(store.latest(spark)) == versions(full)
    touched = spark.read.parquet(f"{tmp_path}/store/history/_version=2").select("k").distinct().collect()
    assert [r.k for r in touched] == [2]  # nothing of the other buckets is written again
    with pytest.raises(RuntimeError):
        store.apply(spark.createDataFrame(part, CHANGES), 4)


def test_change_history_refuses_a_store_without_its_checkpoint(spark, tmp_path):
    store = ChangeHistory(str(tmp_path / "store"), ["k"])
    store.apply(feed(spark, [(1, "a", "c", 10)]), 0)
    with pytest.raises(CheckpointMismatch):
        store.run(spark.readStream.schema(CHANGES).parquet(f"{tmp_path}/store/schema"), str(tmp_path / "new"))


def test_change_history_of_an_empty_batch(spark, tmp_path):
    store = ChangeHistory(str(tmp_path / "store"), ["k"])
    store.apply(feed(spark, [(1, "a", "c", 10)]).limit(0), 0)
    assert store.latest(spark).count() == 0
    store.apply(feed(spark, [(1, "a", "c", 10)]), 1)
    assert versions(store.latest(spark)) == [(1, "a", 10, None)]
