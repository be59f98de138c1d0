"""Dimension changes as batches: many commands against a table, a status for each command.

Commands carry ``cmd_seq``, their order. Every function returns (new table, statuses).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterhouse.operators.chains import LONG_ROWS, PIECE_ROWS, walk_chains
from meterhouse.operators.gate import WINDOWS, init_usage
from meterhouse.operators.quality import PLAN_CONSTRAINTS, QUERY_LOG_CONSTRAINTS, fill_defaults
from meterhouse.operators.shape import with_missing_as_null
from meterhouse.operators.skew import hot_keys, neighbour, number_rows, with_slice
from meterhouse.session import write_and_read

MOVES_PER_FOLD = 10_000
LIMITS = [f"{w}_token_limit" for w in WINDOWS]

# Status texts of a plan update.
STATUS_OK = "success"
STATUS_INACTIVE = "plan_is_inactive"


def _first_claims(commands: DataFrame, name: str, valid: Column, taken: DataFrame) -> DataFrame:
    """Adds ``_owner``: the first valid command that claims ``name``, 0 rows for taken names.

    One partial aggregation per name; no window over copies of one name.
    """
    free = commands.where(valid).join(taken.select(name), name, "left_anti")
    owners = free.groupBy(name).agg(F.min("cmd_seq").alias("_owner"))
    return commands.join(owners, name, "left")


def _with_new_ids(accepted: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Numbers accepted rows after the largest key in use."""
    top = table.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    numbered = number_rows(accepted, ["cmd_seq"], "_no")
    return numbered.withColumn(key, (top + F.col("_no")).cast(dict(table.dtypes)[key])).drop("_no")


def create_plans(plans: DataFrame, commands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New plans (``plan_name`` and the limits); names are unique and NULL limits take defaults."""
    defaults = {c: PLAN_CONSTRAINTS.defaults[c] for c in LIMITS}
    commands = fill_defaults(commands, defaults)
    positive = F.lit(True)
    for c in LIMITS:
        positive = positive & (F.col(c) > 0)
    valid = F.col("plan_name").isNotNull() & positive
    judged = _first_claims(commands, "plan_name", valid, plans).withColumn(
        "status",
        F.when(F.col("plan_name").isNull(), "null_name")
        .when(~positive, "limit_not_positive")
        .when(F.col("_owner") == F.col("cmd_seq"), STATUS_OK)
        .otherwise("duplicate_name"),
    )
    accepted = judged.where(F.col("status") == STATUS_OK).select("cmd_seq", "plan_name", *LIMITS)
    new = _with_new_ids(accepted, plans, "plan_id").withColumn("is_active", F.lit(True))
    table = plans.unionByName(new.drop("cmd_seq").select(*plans.columns))
    return table, judged.select("cmd_seq", "status")


def update_plans(
    plans: DataFrame, commands: DataFrame, hot_rows: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """New limits for active plans; a command that changes nothing reports the plan inactive.

    A limit that is not positive breaks the plan's constraint and refuses its command; a NULL limit is
    legal. "Nothing" is relative to the last legal command before it on the same plan, or to the table.
    """
    limit = {} if hot_rows is None else {"min_rows": hot_rows}
    legal = F.lit(True)
    for c in LIMITS:
        legal = legal & F.coalesce(F.col(c) > 0, F.lit(True))
    applied = commands.where(legal)
    hot = hot_keys(applied, ["plan_id"], "cmd_seq", **limit)
    rows = with_slice(applied, ["plan_id"], "cmd_seq", hot)
    wanted = F.struct(*LIMITS)
    rows = neighbour(rows, ["plan_id"], ["cmd_seq"], wanted, "_before", hot, back=True)
    base = plans.select("plan_id", "is_active", F.struct(*LIMITS).alias("_base"))
    known = rows.join(base, "plan_id", "left")
    before = F.coalesce(F.col("_before"), F.col("_base"))
    changes = F.coalesce("is_active", F.lit(False)) & ~wanted.eqNullSafe(before)
    statuses = known.select(
        "cmd_seq", F.when(changes, STATUS_OK).otherwise(STATUS_INACTIVE).alias("status")
    ).unionByName(
        commands.where(~legal).select("cmd_seq", F.lit("limit_not_positive").alias("status"))
    )
    last = applied.groupBy("plan_id").agg(F.max_by(wanted, "cmd_seq").alias("_last"))
    apply = F.col("is_active") & F.col("_last").isNotNull()
    table = plans.join(last, "plan_id", "left").select(
        *[
            (F.when(apply, F.col("_last")[c]).otherwise(F.col(c)).alias(c) if c in LIMITS else F.col(c))
            for c in plans.columns
        ]
    )
    return table, statuses


def soft_delete(table: DataFrame, commands: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Marks the named rows inactive; unknown keys change nothing."""
    named = commands.select(key).distinct().withColumn("_named", F.lit(True))
    marked = table.join(named, key, "left")
    new = marked.withColumn(
        "is_active", F.when(F.col("_named"), F.lit(False)).otherwise(F.col("is_active"))
    ).select(*table.columns)
    known = table.select(key, F.lit(True).alias("_known"))
    statuses = commands.join(known, key, "left").select(
        "cmd_seq", F.when(F.col("_known"), STATUS_OK).otherwise("unknown").alias("status")
    )
    return new, statuses


def hard_delete(
    table: DataFrame,
    commands: DataFrame,
    key: str,
    references: list[tuple[DataFrame, str]],
) -> tuple[DataFrame, DataFrame]:
    """Removes the named rows unless another table still refers to them."""
    used = None
    for child, column in references:
        keys = child.select(F.col(column).alias(key)).distinct()
        used = keys if used is None else used.unionByName(keys)
    used = used.distinct().withColumn("_used", F.lit(True))
    named = commands.select(key).distinct()
    removable = named.join(used, key, "left_anti")
    known = table.select(key, F.lit(True).alias("_known"))
    statuses = (
        commands.join(known, key, "left")
        .join(used, key, "left")
        .select(
            "cmd_seq",
            F.when(F.col("_known").isNull(), "unknown")
            .when(F.col("_used"), "still_referenced")
            .otherwise(STATUS_OK)
            .alias("status"),
        )
    )
    return table.join(removable, key, "left_anti"), statuses


def _fold_moves(keys: tuple, moves: pa.Table) -> pa.Table:
    """Where each old plan of a fold ends up: from the last move back, a move leads on from its new plan."""
    ends: dict[int, int] = {}
    for move in sorted(moves.to_pylist(), key=lambda m: m["_no"], reverse=True):
        ends[move["old_plan"]] = ends.get(move["new_plan"], move["new_plan"])
    table = {"_fold": [keys[0].as_py()] * len(ends), "old_plan": list(ends), "new_plan": list(ends.values())}
    return pa.table(
        {name: pa.array(table[name], moves.schema.field(name).type) for name in table}
    )


def _then(first: DataFrame, second: DataFrame) -> DataFrame:
    """Routes (_fold, old_plan, new_plan) of two folds, one after the other, by the fold they become."""
    on = (F.col("_fold") == F.col("_next_fold")) & (F.col("new_plan") == F.col("_next_old"))
    after = second.select(
        F.col("_fold").alias("_next_fold"), F.col("old_plan").alias("_next_old"), F.col("new_plan").alias("_next")
    )
    led_on = first.join(after, on, "left").select(
        "_fold", "old_plan", F.coalesce("_next", "new_plan").alias("new_plan")
    )
    return led_on.unionByName(second.join(first, ["_fold", "old_plan"], "left_anti"))


def migrate_users(
    users: DataFrame, commands: DataFrame, plans: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Moves active users from ``old_plan`` to ``new_plan``, commands in order.

    Commands are cut into folds of ``MOVES_PER_FOLD`` that become routes, one for each plan moved, all at
    once; neighbouring folds' routes are then led on pair by pair, which takes as many rounds as halvings.
    Users are joined to where their plan ends up.
    """
    targets = plans.select(F.col("plan_id").alias("new_plan"))
    legal = commands.join(targets, "new_plan", "left_semi").select("cmd_seq", "old_plan", "new_plan")
    rejected = commands.join(targets, "new_plan", "left_anti")
    statuses = legal.select("cmd_seq", F.lit(STATUS_OK).alias("status")).unionByName(
        rejected.select("cmd_seq", F.lit("unknown_plan").alias("status"))
    )
    kind = dict(users.dtypes)["plan_id"]
    numbered = number_rows(legal.where("old_plan is not null"), ["cmd_seq"], "_no")
    moves = numbered.select(
        F.floor((F.col("_no") - 1) / MOVES_PER_FOLD).cast("bigint").alias("_fold"),
        "_no",
        *[F.col(c).cast(kind).alias(c) for c in ("old_plan", "new_plan")],
    )
    routes = moves.groupBy("_fold").applyInArrow(
        _fold_moves, f"_fold bigint, old_plan {kind}, new_plan {kind}"
    )
    routes = write_and_read(routes, "plan-routes")
    folds = routes.agg(F.max("_fold")).first()[0] or 0
    while folds:
        halved = F.shiftright("_fold", 1)
        is_second = F.col("_fold").bitwiseAND(F.lit(1)) == 1
        first = routes.where(~is_second).withColumn("_fold", halved)
        second = routes.where(is_second).withColumn("_fold", halved)
        routes = write_and_read(_then(first, second), "plan-routes")
        folds >>= 1
    ends = routes.select(F.col("old_plan").alias("plan_id"), F.col("new_plan").alias("_to"))
    table = users.join(ends, "plan_id", "left").select(
        *[
            F.when(F.col("is_active"), F.coalesce("_to", "plan_id")).otherwise(F.col("plan_id")).alias(c)
            if c == "plan_id"
            else F.col(c)
            for c in users.columns
        ]
    )
    return table, statuses


def create_users(
    users: DataFrame, plans: DataFrame, commands: DataFrame, now: Column
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New users with a full budget: (users, statuses, usage rows). An inactive plan will do."""
    known = plans.select("plan_id", F.lit(True).alias("_plan"))
    commands = commands.join(known, "plan_id", "left").withColumn(
        "budget", F.coalesce("budget", F.lit(100))
    )
    valid = F.col("user_name").isNotNull() & F.col("_plan") & (F.col("budget") > 0)
    judged = _first_claims(commands, "user_name", valid, users).withColumn(
        "status",
        F.when(F.col("user_name").isNull(), "null_name")
        .when(F.col("_plan").isNull(), "unknown_plan")
        .when(F.col("budget") <= 0, "budget_not_positive")
        .when(F.col("_owner") == F.col("cmd_seq"), STATUS_OK)
        .otherwise("duplicate_name"),
    )
    accepted = judged.where(F.col("status") == STATUS_OK).select(
        "cmd_seq",
        "user_name",
        "plan_id",
        F.col("budget").cast("int").alias("token_budget"),
        F.col("budget").cast("int").alias("remaining_budget"),
        F.lit(True).alias("is_active"),
    )
    new = _with_new_ids(accepted, users, "user_id")
    table = users.unionByName(new.select(*users.columns))
    return table, judged.select("cmd_seq", "status"), init_usage(new, now)


def update_users(
    users: DataFrame, plans: DataFrame, commands: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Name, plan and budget of active users; both budgets restart, spending is forgotten.

    NULL names and budgets break the table's constraints and are refused.
    A name is refused if another user holds it, or an earlier command of another user claims it.
    A name given up in a batch is free from the next batch on.
    """
    known = plans.select("plan_id", F.lit(True).alias("_plan"))
    active = users.select("user_id", F.col("is_active").alias("_active"))
    holders = users.select(F.col("user_name"), F.col("user_id").alias("_holder"))
    rows = (
        commands.join(known, "plan_id", "left")
        .join(active, "user_id", "left")
        .join(holders, "user_name", "left")
    )
    valid = (
        F.coalesce("_active", F.lit(False))
        & F.coalesce("_plan", F.lit(False))
        & F.col("user_name").isNotNull()
        & F.coalesce(F.col("budget") > 0, F.lit(False))
        & (F.col("_holder").isNull() | (F.col("_holder") == F.col("user_id")))
    )
    claims = (
        rows.where(valid)
        .groupBy("user_name")
        .agg(F.min_by("user_id", "cmd_seq").alias("_claimant"))
    )
    judged = rows.join(claims, "user_name", "left").withColumn(
        "status",
        F.when(~F.coalesce("_active", F.lit(False)), "no_effect")
        .when(F.col("_plan").isNull(), "unknown_plan")
        .when(F.col("user_name").isNull(), "null_name")
        .when(F.col("budget").isNull(), "null_budget")
        .when(F.col("budget") <= 0, "budget_not_positive")
        .when(~valid | (F.col("_claimant") != F.col("user_id")), "duplicate_name")
        .otherwise(STATUS_OK),
    )
    last = (
        judged.where(F.col("status") == STATUS_OK)
        .groupBy("user_id")
        .agg(F.max_by(F.struct("user_name", "plan_id", "budget"), "cmd_seq").alias("_last"))
    )
    joined = users.join(last, "user_id", "left")
    renewed = F.col("_last").isNotNull()
    source = {
        "user_name": "user_name",
        "plan_id": "plan_id",
        "token_budget": "budget",
        "remaining_budget": "budget",
    }
    table = joined.select(
        *[
            F.when(renewed, F.col("_last")[source[c]]).otherwise(F.col(c)).alias(c)
            if c in source
            else F.col(c)
            for c in users.columns
        ]
    )
    return table, judged.select("cmd_seq", "status")


BUDGETS = ["token_budget", "remaining_budget"]
BUDGET_MOST = {"int": 2**31 - 1, "bigint": 2**63 - 1}


def _refuse_top_ups(most: list[int], cmd_type: str):
    """Walks over top-ups sorted by user and order; holds two budgets and one batch at a time."""
    cmd_arrow = pa.int32() if cmd_type == "int" else pa.int64()

    def fits(budgets: list, low: int, high: int) -> bool:
        return all(b is None or (b + low > 0 and b + high <= m) for b, m in zip(budgets, most))

    def raised(budgets: list, amount: int) -> list:
        return [b if b is None else b + amount for b in budgets]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        user, budgets = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            users = batch.column("user_id").to_numpy()
            tokens = batch.column("tokens").to_numpy()
            ends = [*(np.flatnonzero(users[1:] != users[:-1]) + 1).tolist(), len(users)]
            accepted, lo = np.ones(len(users), bool), 0
            for hi in ends:
                if user is None or users[lo] != user:
                    user = users[lo]
                    budgets = [batch.column(c)[lo].as_py() for c in BUDGETS]
                amounts = tokens[lo:hi].tolist()
                sums = list(accumulate(amounts))
                if fits(budgets, min(sums), max(sums)):  # no command of the stretch can be refused
                    budgets = raised(budgets, sums[-1])
                else:
                    for n, amount in enumerate(amounts, lo):
                        if fits(budgets, amount, amount):
                            budgets = raised(budgets, amount)
                        else:
                            accepted[n] = False
                lo = hi
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("cmd_seq").cast(cmd_arrow),
                    batch.column("user_id"),
                    batch.column("tokens"),
                    pa.array(accepted),
                ],
                ["cmd_seq", "user_id", "tokens", "accepted"],
            )

    return run


def _accepted_sum() -> Column:
    return F.sum(F.when(F.col("accepted"), F.col("tokens").cast("decimal(38,0)")).otherwise(0))


def add_budget(
    users: DataFrame, commands: DataFrame, long_rows: int = LONG_ROWS, piece_rows: int = PIECE_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Adds ``tokens`` to both budgets of active users, which keep their types.

    A command is refused if a budget would not stay positive or would leave the range of its type; the
    ones after it go on from where it found the budgets. Commands of a user that can only succeed add
    up before the join. Those of a user for whom one might be refused are a chain: they stay rows and
    are walked in order with the two budgets carried along, in pieces of ``piece_rows`` where a user
    has more than ``long_rows``. ``cmd_seq`` is unique. A NULL budget stays NULL and refuses nothing.
    """
    types = dict(users.dtypes)
    most = [BUDGET_MOST[types[c]] for c in BUDGETS]
    active = users.where("is_active").select("user_id", *BUDGETS)
    rows = (
        commands.where(F.col("tokens").isNotNull())
        .select("cmd_seq", "user_id", F.col("tokens").cast("long").alias("tokens"))
        .join(active.select("user_id"), "user_id", "left_semi")
    )
    sums = rows.groupBy("user_id").agg(
        F.sum(F.col("tokens").cast("decimal(38,0)")).alias("_sum"), F.min("tokens").alias("_low")
    )
    doubtful = F.col("_low") <= 0
    for c, m in zip(BUDGETS, most):
        doubtful = doubtful | F.coalesce(F.col(c) + F.col("_sum") > F.lit(m), F.lit(False))
    judged = sums.join(active, "user_id").withColumn("_chain", doubtful)
    judged = write_and_read(judged.select("user_id", "_sum", "_chain", *BUDGETS), "top-up-sums")
    in_chain = judged.where("_chain").select("user_id", *[F.col(c).cast("long") for c in BUDGETS])
    chained = write_and_read(rows.join(in_chain.select("user_id"), "user_id", "left_semi"), "top-ups")

    def carry(state: DataFrame, done: DataFrame) -> DataFrame:
        moved = done.groupBy("user_id").agg(_accepted_sum().alias("_more"))
        after = [(F.col(c) + F.coalesce("_more", F.lit(0))).cast("long").alias(c) for c in BUDGETS]
        return state.join(moved, "user_id", "left").select("user_id", *after)

    seq_type, user_type = (dict(rows.dtypes)[c] for c in ("cmd_seq", "user_id"))
    walked = walk_chains(
        chained, in_chain, "user_id", ["cmd_seq"], _refuse_top_ups(most, seq_type),
        f"cmd_seq {seq_type}, user_id {user_type}, tokens long, accepted boolean",
        carry, long_rows, piece_rows,
    )
    added = (
        judged.where("not _chain")
        .select("user_id", "_sum")
        .unionByName(walked.groupBy("user_id").agg(_accepted_sum().alias("_sum")))
    )
    table = users.join(added, "user_id", "left").select(
        *[
            (F.col(c) + F.coalesce("_sum", F.lit(0))).cast(types[c]).alias(c) if c in BUDGETS else F.col(c)
            for c in users.columns
        ]
    )
    known = active.select("user_id", F.lit(True).alias("_active"))
    known = known.join(judged.select("user_id", "_chain"), "user_id", "left")
    plain = (
        commands.join(known, "user_id", "left")
        .where(~(F.coalesce("_chain", F.lit(False)) & F.col("tokens").isNotNull()))
        .select(
            "cmd_seq",
            F.when(F.col("_active").isNull(), "no_effect")
            .when(F.col("tokens").isNull(), "null_tokens")
            .otherwise(STATUS_OK)
            .alias("status"),
        )
    )
    refused = F.when(F.col("accepted"), STATUS_OK).otherwise("budget_not_positive_or_too_large")
    return table, plain.unionByName(walked.select("cmd_seq", refused.alias("status")))


QUERY_LOG_OPTIONAL = {
    "conversation_id": "string",
    "user_message": "string",
    "llm_response": "string",
    "message_type": "string",
    "allow_budget_override": "boolean",
    "validation_result": "string",
    "tokens_estimated": "int",
    "execution_time_ms": "int",
    "is_successful": "boolean",
}
QUERY_LOG_FILL = {
    **QUERY_LOG_CONSTRAINTS.defaults,
    "allow_budget_override": False,
    "is_successful": True,
}


def append_query_log(log: DataFrame, rows: DataFrame, key: str = "q_id") -> DataFrame:
    """Appends bare or full query rows, numbered after the log, with column defaults filled in.

    ``rows`` carry ``cmd_seq``; columns they lack take the default, or NULL.
    """
    full = fill_defaults(with_missing_as_null(rows, QUERY_LOG_OPTIONAL), QUERY_LOG_FILL)
    numbered = _with_new_ids(full, log, key).drop("cmd_seq")
    return log.unionByName(numbered, allowMissingColumns=True)


def append_request_log(log: DataFrame, rows: DataFrame) -> DataFrame:
    """Appends request rows, numbered after the log; a repeated request id is refused."""
    fresh = rows.join(log.select("request_id"), "request_id", "left_anti")
    firsts = Window.partitionBy("request_id").orderBy("cmd_seq")
    named = (
        fresh.where(F.col("request_id").isNotNull())
        .withColumn("_rank", F.row_number().over(firsts))
        .where("_rank = 1")
        .drop("_rank")
    )
    unnamed = fresh.where(F.col("request_id").isNull())
    numbered = _with_new_ids(named.unionByName(unnamed), log, "log_id").drop("cmd_seq")
    return log.unionByName(numbered, allowMissingColumns=True)
