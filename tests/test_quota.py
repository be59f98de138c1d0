"""Decision tables, NULL cases and the ordered replay."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterhouse.operators import gate, replay
from meterhouse.streaming.metering import MeterStore

PLANS = "plan_id int, plan_name string, hourly_token_limit int, daily_token_limit int, monthly_token_limit int, is_active boolean"
USERS = "user_id int, user_name string, plan_id int, token_budget int, remaining_budget int, is_active boolean"
USAGE = (
    "user_id int, hourly_token int, hourly_session_start timestamp, daily_token int, "
    "daily_session_start timestamp, monthly_token int, monthly_session_start timestamp"
)
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def usage_row(user, h, d, m, at=T0):
    return (user, h, at, d, at, m, at)


@pytest.fixture(scope="module")
def plans(spark):
    return spark.createDataFrame([(1, "basic", 100, 200, 300, True)], PLANS)


@pytest.mark.parametrize(
    "hours, expected",
    [
        (0.99, (5, 6, 7)),
        (1, (0, 6, 7)),
        (23.99, (0, 6, 7)),
        (24, (0, 0, 7)),
        (671.9, (0, 0, 7)),
        (672, (0, 0, 0)),
    ],
)
def test_refresh_bounds(spark, hours, expected):
    usage = spark.createDataFrame([usage_row(1, 5, 6, 7)], USAGE)
    now = T0 + dt.timedelta(hours=hours)
    row = gate.refresh_usage(usage, F.lit(now)).first()
    assert (row["hourly_token"], row["daily_token"], row["monthly_token"]) == expected
    for window, count in zip(("hourly", "daily", "monthly"), expected):
        assert row[f"{window}_session_start"] == (now if count == 0 else T0)


VALIDATE = [
    # counters, allow_budget, remaining, active, message
    ((99, 199, 299), False, 10, True, "ALLOWED"),
    ((100, 0, 0), False, 1000, True, "HOURLY_LIMIT_EXCEEDED"),
    ((100, 0, 0), None, 1000, True, "HOURLY_LIMIT_EXCEEDED"),
    ((100, 200, 0), True, 20, True, "ALLOWED_USING_BUDGET"),
    ((100, 200, 0), True, 19, True, "HOURLY DAILY_LIMIT_EXCEEDED + INSUFFICIENT_BUDGET"),
    ((0, 200, 300), False, 1000, True, "DAILY MONTHLY_LIMIT_EXCEEDED"),
    ((100, 200, 300), False, 1000, True, "HOURLY DAILY MONTHLY_LIMIT_EXCEEDED"),
    ((0, 0, 300), True, 1000, False, "MONTHLY_LIMIT_EXCEEDED + INSUFFICIENT_BUDGET"),
    ((0, 0, 0), True, 1000, False, "ALLOWED"),
]


@pytest.mark.parametrize("counters, allow, remaining, active, message", VALIDATE)
def test_validate_table(spark, plans, counters, allow, remaining, active, message):
    users = spark.createDataFrame([(1, "u", 1, 1000, remaining, active)], USERS)
    usage = spark.createDataFrame([usage_row(1, *counters)], USAGE)
    requests = spark.createDataFrame([(1, allow)], "user_id int, allow_budget boolean")
    row = gate.validate_requests(requests, users, usage, plans).first()
    assert row["validate_msg"] == message
    strict = gate.validate_requests(requests, users, usage, plans, mode="strict").first()
    assert strict["validate_msg"] == (message if active else "USER_NOT_ACTIVE")


def test_validate_unknown_user(spark, plans):
    users = spark.createDataFrame([], USERS)
    usage = spark.createDataFrame([], USAGE)
    requests = spark.createDataFrame([(9, True)], "user_id int, allow_budget boolean")
    assert gate.validate_requests(requests, users, usage, plans).first()["validate_msg"] == "ALLOWED"


RECORD = [
    # counters, tokens, allow, remaining, message, charged, counters after
    ((0, 0, 0), 100, False, 10, "SUCCESS", 0, (100, 100, 100)),
    ((1, 0, 0), 100, False, 10, "PLAN_LIMIT_EXCEEDED", 0, (1, 0, 0)),
    ((1, 0, 0), 100, True, 10, "SUCCESS_USING_OVERFLOW", 1, (100, 100, 100)),
    ((50, 150, 290), 100, True, 91, "SUCCESS_USING_OVERFLOW", 90, (100, 200, 300)),
    ((50, 150, 290), 100, True, 90, "CHECK_VIOLATION", 0, (50, 150, 290)),
    ((50, 150, 290), 100, True, 89, "INSUFFICIENT_BUDGET", 0, (50, 150, 290)),
    # a counter above a lowered limit falls back to the limit
    ((150, 0, 0), 10, True, 100, "SUCCESS_USING_OVERFLOW", 60, (100, 10, 10)),
]


@pytest.mark.parametrize("counters, tokens, allow, remaining, message, charged, after", RECORD)
def test_record_table(spark, plans, counters, tokens, allow, remaining, message, charged, after):
    users = spark.createDataFrame([(1, "u", 1, 1000, remaining, True)], USERS)
    usage = spark.createDataFrame([usage_row(1, *counters)], USAGE)
    requests = spark.createDataFrame(
        [(1, tokens, allow)], "user_id int, tokens int, allow_budget boolean"
    )
    row = gate.record_usage(requests, users, usage, plans).first()
    assert (row["record_msg"], row["charged"]) == (message, charged)
    assert (row["hourly_token"], row["daily_token"], row["monthly_token"]) == after
    assert row["remaining_budget"] == remaining - charged


def test_remaining_limits_of_inactive_user_is_no_row(spark, plans):
    users = spark.createDataFrame([(1, "a", 1, 9, 8, True), (2, "b", 1, 9, 9, False)], USERS)
    usage = spark.createDataFrame([usage_row(1, 150, 20, 30), usage_row(2, 0, 0, 0)], USAGE)
    rows = gate.remaining_limits(users, usage, plans).collect()
    assert [tuple(r) for r in rows] == [(1, "a", 8, -50, 180, 270)]


# --- replay ----------------------------------------------------------------------------------


def slow_gate(requests, user, limits, budget, active, mode):
    """The two decision tables written out for one user, as a check of the scan."""
    counters, starts, remaining, out = None, None, budget, []
    for seq, ts, tokens, allow in sorted(requests, key=lambda r: (r[1], r[0])):
        if counters is None:
            counters, starts = [0, 0, 0], [ts] * 3
        old = (list(counters), list(starts))
        for i, hours in enumerate((1, 24, 672)):
            if ts - starts[i] >= dt.timedelta(hours=hours):
                counters[i], starts[i] = 0, ts
        hit = [n for n, c, x in zip(("HOURLY", "DAILY", "MONTHLY"), counters, limits) if c >= x]
        record, charged = None, 0
        if not hit:
            message = "ALLOWED"
        elif not allow:
            message = " ".join(hit) + "_LIMIT_EXCEEDED"
        elif active and remaining >= 0.02 * budget:
            message = "ALLOWED_USING_BUDGET"
        else:
            message = " ".join(hit) + "_LIMIT_EXCEEDED + INSUFFICIENT_BUDGET"
        if message.startswith("ALLOWED"):
            over = [max(0, c + tokens - x) for c, x in zip(counters, limits)]
            need = max(over)
            if need == 0:
                record = "SUCCESS"
            elif not allow:
                record = "PLAN_LIMIT_EXCEEDED"
            elif remaining > need:
                record, charged = "SUCCESS_USING_OVERFLOW", need
            else:
                record = "CHECK_VIOLATION" if remaining == need else "INSUFFICIENT_BUDGET"
            if record.startswith("SUCCESS"):
                counters = [c + tokens - o for c, o in zip(counters, over)]
                remaining -= charged
        elif mode == "api":
            counters, starts = old
        out.append((seq, user, message, record, charged, *counters, remaining))
    return out


@pytest.fixture(scope="module")
def traffic(spark, plans):
    rng = random.Random(3)
    rows, ts = [], T0
    for seq in range(1800):
        user = 1 if seq % 3 == 0 else rng.randrange(2, 12)
        ts += dt.timedelta(minutes=rng.randrange(0, 90))
        rows.append((seq, user, ts, rng.randrange(0, 80), rng.random() < 0.5))
    users = [(u, f"u{u}", 1, 400, 400, u % 4 != 0) for u in range(1, 12)]
    requests = spark.createDataFrame(
        rows, "request_seq bigint, user_id int, ts timestamp, tokens int, allow_budget boolean"
    )
    return rows, users, requests, spark.createDataFrame(users, USERS)


COLUMNS = [
    "request_seq",
    "user_id",
    "validate_msg",
    "record_msg",
    "charged",
    "hourly_token",
    "daily_token",
    "monthly_token",
    "remaining_budget",
]


@pytest.mark.parametrize("mode", ["procedure", "api"])
@pytest.mark.parametrize(
    "sizes", [{}, {"long_rows": 300, "piece_rows": 100}, {"long_rows": 0, "piece_rows": 70}]
)
def test_replay_equals_plain_loop(traffic, plans, rows_of, mode, sizes):
    rows, users, requests, users_df = traffic
    expected = []
    for user, _, _, budget, _, active in users:
        mine = [(s, ts, tokens, allow) for s, u, ts, tokens, allow in rows if u == user]
        expected += slow_gate(mine, user, (100, 200, 300), budget, active, mode)
    result = replay.replay_gate(requests, users_df, plans, mode=mode, **sizes)
    assert rows_of(result, *COLUMNS) == sorted(expected, key=str)


@pytest.mark.parametrize("mode, sizes", [("procedure", {}), ("api", {"long_rows": 60, "piece_rows": 150})])
def test_batches_of_any_size_equal_one_replay(spark, traffic, plans, rows_of, tmp_path, mode, sizes):
    rows, _, requests, users = traffic
    limits = replay.user_limits(users, plans)
    store = MeterStore(str(tmp_path), limits, mode, buckets=4, **sizes)
    cuts = [0, 900, 900, 910, 1500, 1800]  # one batch is empty, one touches few buckets
    for n, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        part = requests.where(F.col("request_seq").between(lo, hi - 1))
        for _ in range(2 if n == 2 else 1):  # a batch that is replayed
            store.apply(part, n)
    whole = replay.replay_gate(requests, users, plans, mode=mode)
    assert rows_of(store.outcomes(spark), *COLUMNS) == rows_of(whole, *COLUMNS)
    names = ["user_id", "hourly_token", "daily_token", "monthly_token", "remaining_budget"]
    assert rows_of(store.counters(spark), *names) == rows_of(replay.final_state(whole), *names)
    with pytest.raises(RuntimeError):
        store.apply(requests, 7)


def test_meter_store_before_any_batch(spark, traffic, plans, tmp_path):
    _, users, requests, users_df = traffic
    store = MeterStore(str(tmp_path), replay.user_limits(users_df, plans))
    assert store.outcomes(spark).count() == store.counters(spark).count() == 0
    store.apply(requests.withColumn("user_id", F.lit(99)), 0)  # a user nobody knows
    assert store.outcomes(spark).count() == store.counters(spark).count() == 0


def test_replay_starts_from_given_counters(spark, plans):
    users = spark.createDataFrame([(1, "u", 1, 1000, 500, True)], USERS)
    usage = spark.createDataFrame([usage_row(1, 90, 150, 250)], USAGE)
    requests = spark.createDataFrame(
        [(1, 1, T0 + dt.timedelta(minutes=59), 20, True), (2, 1, T0 + dt.timedelta(hours=1), 20, True)],
        "request_seq bigint, user_id int, ts timestamp, tokens int, allow_budget boolean",
    )
    rows = replay.replay_gate(requests, users, plans, usage=usage).orderBy("request_seq").collect()
    assert [(r["outcome"], r["charged"], r["hourly_token"], r["daily_token"]) for r in rows] == [
        ("SUCCESS_USING_OVERFLOW", 10, 100, 170),
        ("SUCCESS", 0, 20, 190),
    ]


def test_replay_invariants(tables):
    out = replay.replay_gate(tables.gate_requests(), tables.users(), tables.plans()).cache()
    limits = tables.plans().select("plan_id", "hourly_token_limit", "monthly_token_limit")
    over = out.join(limits, "plan_id").where(
        "hourly_token > hourly_token_limit or monthly_token > monthly_token_limit"
    )
    assert over.count() == 0
    spent = out.groupBy("user_id").agg(F.sum("charged").alias("charged"))
    left = replay.final_state(out).join(tables.users().select("user_id", "token_budget"), "user_id")
    gap = left.join(spent, "user_id").where("token_budget - charged <> remaining_budget")
    assert gap.count() == 0


def test_outcome_totals(spark):
    """Totals known from a plain loop, with inactive users treated like active ones."""
    from meterhouse.plans.fixtures import Tables

    t = Tables(spark, "/root/testdata/sf0.01")
    out = replay.replay_gate(t.gate_requests(), t.users(), t.plans(), honour_active=False)
    totals = {r["outcome"]: r["count"] for r in out.groupBy("outcome").count().collect()}
    assert totals == {
        "SUCCESS": 7612,
        "PLAN_LIMIT_EXCEEDED": 933,
        "SUCCESS_USING_OVERFLOW": 880,
        "INSUFFICIENT_BUDGET": 252,
        "CHECK_VIOLATION": 7,
        "MONTHLY_LIMIT_EXCEEDED": 157,
        "DAILY_LIMIT_EXCEEDED": 100,
        "MONTHLY_LIMIT_EXCEEDED + INSUFFICIENT_BUDGET": 36,
        "HOURLY_LIMIT_EXCEEDED": 15,
        "HOURLY DAILY_LIMIT_EXCEEDED": 4,
        "DAILY_LIMIT_EXCEEDED + INSUFFICIENT_BUDGET": 2,
        "DAILY MONTHLY_LIMIT_EXCEEDED": 2,
    }
