"""The administration script's cases, step by step, and batch semantics of the commands."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterhouse.operators import dimensions as dims
from meterhouse.operators import gate, reads, replay

PLANS = "plan_id int, plan_name string, hourly_token_limit int, daily_token_limit int, monthly_token_limit int, is_active boolean"
USERS = "user_id int, user_name string, plan_id int, token_budget int, remaining_budget int, is_active boolean"
NEW_PLANS = "cmd_seq bigint, plan_name string, hourly_token_limit int, daily_token_limit int, monthly_token_limit int"
LIMITS = "cmd_seq bigint, plan_id int, hourly_token_limit int, daily_token_limit int, monthly_token_limit int"
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def statuses(df):
    return {r["cmd_seq"]: r["status"] for r in df.collect()}


def test_administration_script(spark):
    now = F.lit(T0)
    plans, status = dims.create_plans(
        spark.createDataFrame([], PLANS),
        spark.createDataFrame(
            [
                (1, "Basic", 1000, 25000, 100000),
                (2, "plus", 5000, 125000, 500000),
                (3, "pro", 10000, 250000, 1000000),
                (4, "Basic", 10000, 25000, 100000),
                (5, None, 1000, 25000, 100000),
                (6, "NegativePlan", -100, 10000, 100000),
            ],
            NEW_PLANS,
        ),
    )
    assert statuses(status) == {
        1: "success",
        2: "success",
        3: "success",
        4: "duplicate_name",
        5: "null_name",
        6: "limit_not_positive",
    }
    assert rows(plans)[0] == (1, "Basic", 1000, 25000, 100000, True)

    plans, status = dims.update_plans(plans, spark.createDataFrame([(1, 1, 2000, 50000, 200000)], LIMITS))
    assert statuses(status) == {1: "success"}
    plans, _ = dims.soft_delete(plans, spark.createDataFrame([(1, 1)], "cmd_seq int, plan_id int"), "plan_id")
    plans, status = dims.update_plans(plans, spark.createDataFrame([(1, 1, 3000, 60000, 300000)], LIMITS))
    assert statuses(status) == {1: "plan_is_inactive"}
    assert rows(reads.active_plans(plans).select("plan_id")) == [(2,), (3,)]
    assert rows(reads.plan_details(plans, 1)) == [(1, "Basic", 2000, 50000, 200000, False)]

    users, status, usage = dims.create_users(
        spark.createDataFrame([], USERS),
        plans,
        spark.createDataFrame(
            [
                (1, "john", 1, 1000),
                (2, "cena", 1, 2000),
                (3, "Alice", 2, 5000),
                (4, "Brad", 3, 7000),
                (5, "Dan", 3, 10000),
                (6, "Ethan", 3, 8000),
                (7, "Bob", 999, 1000),
            ],
            "cmd_seq bigint, user_name string, plan_id int, budget int",
        ),
        now,
    )
    assert statuses(status)[7] == "unknown_plan"
    assert users.count() == usage.count() == 6

    users, status = dims.update_users(
        users,
        plans,
        spark.createDataFrame(
            [(1, 2, "caren", 1, 1000), (2, 8, "AlexNew", 1, 1000)],
            "cmd_seq bigint, user_id int, user_name string, plan_id int, budget int",
        ),
    )
    assert statuses(status) == {1: "success", 2: "no_effect"}
    users, _ = dims.add_budget(
        users, spark.createDataFrame([(1, 3, 1000)], "cmd_seq bigint, user_id int, tokens int")
    )
    users, _ = dims.soft_delete(users, spark.createDataFrame([(1, 2)], "cmd_seq int, user_id int"), "user_id")
    assert rows(reads.user_details(users, 2)) == [(2, "caren", 1, 1000, 1000, False)]
    assert rows(reads.user_details(users, 3)) == [(3, "Alice", 2, 6000, 6000, True)]

    left = {r["user_id"]: tuple(r)[2:] for r in gate.remaining_limits(users, usage, plans).collect()}
    assert 2 not in left
    assert left[3] == (6000, 5000, 125000, 500000)
    assert left[1] == (1000, 2000, 50000, 200000)

    users, _ = dims.migrate_users(
        users, spark.createDataFrame([(1, 1, 2)], "cmd_seq bigint, old_plan int, new_plan int"), plans
    )
    assert {r["user_id"]: r["plan_id"] for r in users.collect() if r["user_id"] < 3} == {1: 2, 2: 1}

    requests = spark.createDataFrame(
        [(1, 1, T0, 100, False), (2, 1, T0, 5200, False), (3, 1, T0, 5200, True)],
        "request_seq bigint, user_id int, ts timestamp, tokens int, allow_budget boolean",
    )
    out = replay.replay_gate(requests, users, plans, usage=usage).orderBy("request_seq").collect()
    assert [r["validate_msg"] for r in out] == ["ALLOWED"] * 3
    assert [r["record_msg"] for r in out] == [
        "SUCCESS",
        "PLAN_LIMIT_EXCEEDED",
        "SUCCESS_USING_OVERFLOW",
    ]
    state = [(r["hourly_token"], r["daily_token"], r["monthly_token"], r["remaining_budget"]) for r in out]
    assert state == [(100, 100, 100, 1000), (100, 100, 100, 1000), (5000, 5300, 5300, 700)]

    log = replay.log_rows(replay.replay_gate(requests, users, plans, usage=usage))
    bare = log.where("not is_full and query_status = 'success'").orderBy(F.desc("request_seq"))
    assert [r["tokens_used"] for r in bare.collect()] == [5200, 100]


def test_same_limits_again_report_inactive(spark):
    plans = spark.createDataFrame([(1, "a", 10, 20, 30, True)], PLANS)
    commands = [(1, 1, 10, 20, 30), (2, 1, 11, 20, 30), (3, 1, 11, 20, 30), (4, 9, 1, 1, 1)]
    table, status = dims.update_plans(plans, spark.createDataFrame(commands, LIMITS))
    assert statuses(status) == {
        1: "plan_is_inactive",
        2: "success",
        3: "plan_is_inactive",
        4: "plan_is_inactive",
    }
    assert rows(table) == [(1, "a", 11, 20, 30, True)]


def test_hot_plan_updates_equal_plain_ones(spark, tables):
    commands = tables.raw("orders").select(
        F.col("o_orderkey").alias("cmd_seq"),
        F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_orderkey") % 4).cast("int").alias("plan_id"),
        (F.col("o_orderkey") % 5 + 60).cast("int").alias("hourly_token_limit"),
        F.lit(500).alias("daily_token_limit"),
        F.lit(5000).alias("monthly_token_limit"),
    )
    plain = dims.update_plans(tables.plans(), commands)[1]
    sliced = dims.update_plans(tables.plans(), commands, hot_rows=300)[1]
    assert rows(plain) == rows(sliced)


def test_names_are_claimed_in_order(spark):
    plans = spark.createDataFrame([(1, "p", 1, 1, 1, True)], PLANS)
    users = spark.createDataFrame([(1, "a", 1, 5, 5, True), (2, "b", 1, 5, 5, True)], USERS)
    commands = spark.createDataFrame(
        [(1, 1, "b", 1, 9), (2, 1, "c", 1, 0), (3, 2, "c", 1, 7), (4, 1, "c", 1, 8), (5, 2, "d", 1, 6)],
        "cmd_seq bigint, user_id int, user_name string, plan_id int, budget int",
    )
    table, status = dims.update_users(users, plans, commands)
    assert statuses(status) == {
        1: "duplicate_name",
        2: "budget_not_positive",
        3: "success",
        4: "duplicate_name",
        5: "success",
    }
    assert rows(table) == [(1, "a", 1, 5, 5, True), (2, "d", 1, 6, 6, True)]


def test_hard_delete_refuses_referenced_rows(spark):
    plans = spark.createDataFrame([(i, f"p{i}", 1, 1, 1, True) for i in (1, 2, 3)], PLANS)
    users = spark.createDataFrame([(1, "a", 2, 5, 5, False)], USERS)
    commands = spark.createDataFrame([(1, 1), (2, 2), (3, 7)], "cmd_seq int, plan_id int")
    table, status = dims.hard_delete(plans, commands, "plan_id", [(users, "plan_id")])
    assert statuses(status) == {1: "success", 2: "still_referenced", 3: "unknown"}
    assert [r[0] for r in rows(table)] == [2, 3]


def test_moves_follow_their_order(spark, monkeypatch):
    plans = spark.createDataFrame([(i, f"p{i}", 1, 1, 1, True) for i in (1, 2, 3)], PLANS)
    users = spark.createDataFrame([(i, f"u{i}", i, 5, 5, True) for i in (1, 2, 3)], USERS)
    moves = spark.createDataFrame(
        [(1, 2, 3), (2, 1, 2), (3, 3, 1), (4, 2, 9)], "cmd_seq bigint, old_plan int, new_plan int"
    )
    for per_fold in (10_000, 1):
        monkeypatch.setattr(dims, "MOVES_PER_FOLD", per_fold)
        table, status = dims.migrate_users(users, moves, plans)
        assert {r[0]: r[2] for r in rows(table)} == {1: 2, 2: 1, 3: 1}
        assert statuses(status)[4] == "unknown_plan"


def test_appended_rows_take_defaults(spark):
    log = spark.createDataFrame([], "q_id bigint, user_id int, query_status string, tokens_used int, message_type string, is_successful boolean")
    bare = spark.createDataFrame([(1, 5, "failed", 0), (2, 6, "success", 9)], "cmd_seq bigint, user_id int, query_status string, tokens_used int")
    out = dims.append_query_log(log, bare)
    assert rows(out.select("q_id", "message_type", "is_successful", "allow_budget_override", "tokens_estimated")) == [
        (1, "llm_query", True, False, None),
        (2, "llm_query", True, False, None),
    ]


def top_ups_by_hand(users, commands, most):
    """(budgets of each user, status of each command), one command after the other."""
    budgets = {u: [a, b] for u, _, _, a, b, active in users if active}
    status = {}
    for seq, user, tokens in sorted(commands):
        if user not in budgets:
            status[seq] = "no_effect"
        elif tokens is None:
            status[seq] = "null_tokens"
        elif all(b is None or 0 < b + tokens <= most for b in budgets[user]):
            budgets[user] = [b if b is None else b + tokens for b in budgets[user]]
            status[seq] = "success"
        else:
            status[seq] = "budget_not_positive_or_too_large"
    return budgets, status


@pytest.mark.parametrize("limits", [{}, {"long_rows": 100, "piece_rows": 60}, {"long_rows": 0, "piece_rows": 25}])
@pytest.mark.parametrize("kind, most", [("int", 2**31 - 1), ("bigint", 2**63 - 1)])
def test_top_ups_equal_one_after_the_other(spark, limits, kind, most):
    rng = random.Random(str(limits) + kind)
    users = [(u, f"u{u}", 1, rng.choice([5, 1000, most - 50]), rng.choice([3, 900, most]), u % 7 != 0) for u in range(30)]
    users.append((30, "none", 1, None, 40, True))
    commands = []
    for seq in range(1200):
        user = 1 if seq % 3 == 0 else rng.choice([*range(33), None])  # one user has a third of them
        tokens = rng.choice([None, 0, 1, 7, 60, 400, most // 3])
        commands.append((seq, user, -tokens if tokens and user in (1, 4, 30) and rng.random() < 0.5 else tokens))
    rng.shuffle(commands)
    table, status = dims.add_budget(
        spark.createDataFrame(users, USERS.replace("budget int", f"budget {kind}")),
        spark.createDataFrame(commands, f"cmd_seq bigint, user_id int, tokens {kind}"),
        **limits,
    )
    budgets, expected = top_ups_by_hand(users, [c for c in commands], most)
    assert table.columns == [c.split()[0] for c in USERS.split(", ")]
    assert dict(table.dtypes)["token_budget"] == kind
    assert statuses(status) == expected and status.count() == len(commands)
    found = {r["user_id"]: [r["token_budget"], r["remaining_budget"]] for r in table.collect()}
    assert found == {u: budgets.get(u, [a, b]) for u, _, _, a, b, _ in users}


def test_no_top_ups(spark):
    users = spark.createDataFrame([(1, "a", 1, 10, 10, True)], USERS)
    table, status = dims.add_budget(users, spark.createDataFrame([], "cmd_seq int, user_id int, tokens int"))
    assert rows(table) == rows(users) and status.count() == 0


@pytest.mark.parametrize("fold", [1, 3, 7, 1000])
def test_moves_in_folds_equal_one_after_the_other(spark, monkeypatch, fold):
    monkeypatch.setattr(dims, "MOVES_PER_FOLD", fold)
    rng = random.Random(fold)
    plans = [(p, f"p{p}", 1, 1, 1, True) for p in range(8)]
    users = [(u, f"u{u}", rng.randrange(9), 1, 1, u % 5 != 0) for u in range(60)]
    moves = [(n, rng.choice([*range(9), None]), rng.choice([*range(9), None])) for n in range(29)]
    at, status = {u: plan for u, _, plan, *_ in users}, {}
    for n, old, new in moves:
        status[n] = "success" if new in range(8) else "unknown_plan"
        if new in range(8):
            at |= {u: new for u, _, _, _, _, active in users if active and old == at[u]}
    rng.shuffle(moves)
    table, told = dims.migrate_users(
        spark.createDataFrame(users, USERS),
        spark.createDataFrame(moves, "cmd_seq bigint, old_plan int, new_plan int"),
        spark.createDataFrame(plans, PLANS),
    )
    assert {r["user_id"]: r["plan_id"] for r in table.collect()} == at
    assert statuses(told) == status


def test_no_moves(spark):
    users = spark.createDataFrame([(1, "a", 1, 10, 10, True)], USERS)
    plans = spark.createDataFrame([(1, "p", 1, 1, 1, True)], PLANS)
    none = spark.createDataFrame([], "cmd_seq bigint, old_plan int, new_plan int")
    table, status = dims.migrate_users(users, none, plans)
    assert rows(table) == rows(users) and status.count() == 0
