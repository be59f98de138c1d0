"""Quota decisions for many requests at once, with the counters given.

The same decision expressions serve the set-based operators here and the ordered replay in
``operators.replay``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterhouse.functions.columns import whole_hours

# Window names in message order, with their length in whole hours.
WINDOWS = {"hourly": 1, "daily": 24, "monthly": 24 * 28}

# Outcome messages.
ALLOWED = "ALLOWED"
ALLOWED_USING_BUDGET = "ALLOWED_USING_BUDGET"
LIMIT_EXCEEDED = "_LIMIT_EXCEEDED"
NO_BUDGET_SUFFIX = "_LIMIT_EXCEEDED + INSUFFICIENT_BUDGET"
SUCCESS = "SUCCESS"
SUCCESS_USING_OVERFLOW = "SUCCESS_USING_OVERFLOW"
INSUFFICIENT_BUDGET = "INSUFFICIENT_BUDGET"
PLAN_LIMIT_EXCEEDED = "PLAN_LIMIT_EXCEEDED"
CHECK_VIOLATION = "CHECK_VIOLATION"
FOREIGN_KEY_VIOLATION = "FOREIGN_KEY_VIOLATION"
USER_NOT_ACTIVE = "USER_NOT_ACTIVE"
PASSED = [ALLOWED, ALLOWED_USING_BUDGET]
CHARGED = [SUCCESS, SUCCESS_USING_OVERFLOW]

# Fixed value: budget use needs two percent of the total budget left.
BUDGET_FLOOR_PERCENT = 2


def refresh_usage(usage: DataFrame, now: Column) -> DataFrame:
    """Resets each expired counter; its next window starts now, not at a clock hour."""
    out = {}
    for window, hours in WINDOWS.items():
        start = F.col(f"{window}_session_start")
        expired = whole_hours(start, now) >= hours
        out[f"{window}_token"] = F.when(expired, F.lit(0)).otherwise(F.col(f"{window}_token"))
        out[f"{window}_session_start"] = F.when(expired, now).otherwise(start)
    return usage.withColumns(out)


def validate_message(
    counters: dict[str, Column],
    limits: dict[str, Column],
    allow: Column,
    remaining: Column,
    budget: Column,
) -> Column:
    """The admission message. A counter that reached its limit blocks; NULL blocks nothing."""
    hit = F.concat_ws(
        " ", *[F.when(counters[w] >= limits[w], F.lit(w.upper())) for w in WINDOWS]
    )
    enough = remaining * 100 >= budget * BUDGET_FLOOR_PERCENT
    return (
        F.when(hit == "", ALLOWED)
        .when(~F.coalesce(allow, F.lit(False)), F.concat(hit, F.lit(LIMIT_EXCEEDED)))
        .when(enough, ALLOWED_USING_BUDGET)
        .otherwise(F.concat(hit, F.lit(NO_BUDGET_SUFFIX)))
    )


def overflow(counter: Column, tokens: Column, limit: Column) -> Column:
    """Tokens beyond a limit, 0 if they fit."""
    beyond = counter + tokens - limit
    return F.when(beyond > 0, beyond).otherwise(F.lit(0))


def record_message(need: Column, allow: Column, remaining: Column) -> Column:
    """The recording message; a budget may shrink but not reach zero."""
    return (
        F.when(need <= 0, SUCCESS)
        .when(~F.coalesce(allow, F.lit(False)), PLAN_LIMIT_EXCEEDED)
        .when(remaining > need, SUCCESS_USING_OVERFLOW)
        .when(remaining == need, CHECK_VIOLATION)
        .otherwise(INSUFFICIENT_BUDGET)
    )


def with_gate_state(
    requests: DataFrame, users: DataFrame, usage: DataFrame, plans: DataFrame
) -> DataFrame:
    """Requests with their user's budget, counters and plan limits; NULLs for unknown users.

    The dimensions are joined to each other first, once per user, so the requests are shuffled at
    most once.
    """
    limits = plans.select("plan_id", *[f"{w}_token_limit" for w in WINDOWS])
    state = (
        users.select("user_id", "plan_id", "token_budget", "remaining_budget", "is_active")
        .join(limits, "plan_id")
        .join(usage.withColumn("_metered", F.lit(True)), "user_id", "left")
    )
    return requests.join(state, "user_id", "left")


def _columns(suffix: str) -> dict[str, Column]:
    return {w: F.col(f"{w}{suffix}") for w in WINDOWS}


def validate_requests(
    requests: DataFrame,
    users: DataFrame,
    usage: DataFrame,
    plans: DataFrame,
    now: Column | None = None,
    mode: str = "reference",
) -> DataFrame:
    """Adds ``validate_msg`` (and the user's plan) to each request, all against the same counters.

    In ``reference`` mode an inactive user is judged by the counters with no budget to use, and an
    unknown user is allowed. ``strict`` answers both with ``USER_NOT_ACTIVE``.
    """
    fresh = usage if now is None else refresh_usage(usage, now)
    joined = with_gate_state(requests, users, fresh, plans)
    active = F.coalesce("is_active", F.lit(False))
    message = validate_message(
        _columns("_token"),
        _columns("_token_limit"),
        F.col("allow_budget"),
        F.when(active, F.col("remaining_budget")),
        F.col("token_budget"),
    )
    if mode == "strict":
        message = F.when(active, message).otherwise(USER_NOT_ACTIVE)
    return joined.select(
        *requests.columns,
        F.when(active, F.col("plan_id")).alias("plan_id"),
        message.alias("validate_msg"),
    )


def record_usage(
    requests: DataFrame, users: DataFrame, usage: DataFrame, plans: DataFrame
) -> DataFrame:
    """Adds to each request the recording message, the overflow and the state it would leave.

    Each request is judged on its own against the given counters; a sequence of requests is
    ``replay_gate``. Activity is not checked here.
    """
    joined = with_gate_state(requests, users, usage, plans)
    tokens = F.col("tokens")
    beyond = {
        w: overflow(F.col(f"{w}_token"), tokens, F.col(f"{w}_token_limit")) for w in WINDOWS
    }
    joined = joined.withColumns({f"_over_{w}": c for w, c in beyond.items()})
    joined = joined.withColumn("need", F.greatest(*[F.col(f"_over_{w}") for w in WINDOWS]))
    message = F.when(F.col("plan_id").isNull(), FOREIGN_KEY_VIOLATION).otherwise(
        record_message(F.col("need"), F.col("allow_budget"), F.col("remaining_budget"))
    )
    joined = joined.withColumn("record_msg", message)
    charged = F.col("record_msg").isin(CHARGED)
    after = [
        F.when(charged, F.col(f"{w}_token") + tokens - F.col(f"_over_{w}"))
        .otherwise(F.col(f"{w}_token"))
        .alias(f"{w}_token")
        for w in WINDOWS
    ]
    return joined.select(
        *requests.columns,
        "plan_id",
        "record_msg",
        F.when(charged, F.col("need")).otherwise(0).alias("charged"),
        *after,
        F.when(charged, F.col("remaining_budget") - F.col("need"))
        .otherwise(F.col("remaining_budget"))
        .alias("remaining_budget"),
    )


def remaining_limits(users: DataFrame, usage: DataFrame, plans: DataFrame) -> DataFrame:
    """Tokens left per window and budget of each active user; negative after a plan cut."""
    return (
        users.where("is_active")
        .join(usage, "user_id")
        .join(plans.select("plan_id", *[f"{w}_token_limit" for w in WINDOWS]), "plan_id")
        .select(
            "user_id",
            "user_name",
            "remaining_budget",
            *[
                (F.col(f"{w}_token_limit") - F.col(f"{w}_token")).alias(f"{w}_remaining")
                for w in WINDOWS
            ],
        )
    )


def init_usage(users: DataFrame, now: Column, existing: DataFrame | None = None) -> DataFrame:
    """Zero counters, started now, for users that have none yet."""
    if existing is not None:
        users = users.join(existing.select("user_id"), "user_id", "left_anti")
    cols = []
    for w in WINDOWS:
        cols.append(F.lit(0).alias(f"{w}_token"))
        cols.append(now.alias(f"{w}_session_start"))
    return users.select("user_id", *cols)


def blocked_log(decisions: DataFrame, ts: str = "ts") -> DataFrame:
    """Log rows of the requests that admission refused: failed, no tokens."""
    return decisions.where(~F.col("validate_msg").isin([*PASSED, USER_NOT_ACTIVE])).select(
        "user_id",
        "plan_id",
        F.col(ts).alias("time_stamp"),
        F.lit("failed").alias("query_status"),
        F.lit(0).alias("tokens_used"),
    )
