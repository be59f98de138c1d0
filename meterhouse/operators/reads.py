"""Read queries of the metering data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterhouse.functions.columns import response_label, trace_length
from meterhouse.operators.gate import remaining_limits
from meterhouse.operators.shape import with_missing_as_null

PLAN_FIELDS = [
    "plan_id",
    "plan_name",
    "hourly_token_limit",
    "daily_token_limit",
    "monthly_token_limit",
]
USER_FIELDS = [
    "user_id",
    "user_name",
    "plan_id",
    "token_budget",
    "remaining_budget",
    "is_active",
]
USAGE_FIELDS = [
    "user_id",
    "hourly_token",
    "hourly_session_start",
    "daily_token",
    "daily_session_start",
    "monthly_token",
    "monthly_session_start",
]
CHAT_FIELDS = [
    "q_id",
    "conversation_id",
    "user_message",
    "llm_response",
    "tokens_used",
    "validation_result",
    "query_status",
    "time_stamp",
]
CHAT_LENGTH = 100


def active_plans(plans: DataFrame) -> DataFrame:
    return plans.where("is_active").select(*PLAN_FIELDS)


def plan_details(plans: DataFrame, plan_id: int) -> DataFrame:
    return plans.where(F.col("plan_id") == plan_id).select(*PLAN_FIELDS, "is_active")


def list_users(users: DataFrame) -> DataFrame:
    return users.select(*USER_FIELDS)


def user_details(users: DataFrame, user_id: int) -> DataFrame:
    return list_users(users).where(F.col("user_id") == user_id)


def active_users(users: DataFrame) -> DataFrame:
    return users.where("is_active").select(
        "user_id", F.concat("user_name", F.lit(" (id "), "user_id", F.lit(")")).alias("label")
    )


def current_usage(usage: DataFrame, user_id: int | None = None) -> DataFrame:
    rows = usage.select(*USAGE_FIELDS)
    return rows if user_id is None else rows.where(F.col("user_id") == user_id)


def query_history(query_log: DataFrame, user_id: int) -> DataFrame:
    """All log rows of a user, newest first."""
    return query_log.where(F.col("user_id") == user_id).orderBy(F.desc("time_stamp"))


def chat_history(
    query_log: DataFrame, user_id: int | None = None, latest: int = CHAT_LENGTH
) -> DataFrame:
    """The latest model queries, newest first: of one user, or of every user at once.

    For all users Spark cuts each user to ``latest`` rows inside the map tasks.
    """
    optional = {c: "string" for c in ("user_message", "llm_response", "validation_result")}
    rows = with_missing_as_null(query_log, optional)
    rows = rows.where(F.col("message_type") == "llm_query")
    newest = [F.desc("time_stamp"), F.desc("q_id")]
    if user_id is not None:
        one = rows.where(F.col("user_id") == user_id)
        return one.orderBy(*newest).limit(latest).select(*CHAT_FIELDS)
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy(*newest))
    return (
        rows.where(F.col("user_id").isNotNull())
        .withColumn("recency", rank)
        .where(F.col("recency") <= latest)
        .select("user_id", "recency", *CHAT_FIELDS)
    )


def chat_transcript(history: DataFrame, order: list[str]) -> DataFrame:
    """Each logged query as a user turn and an answer turn with a status note, oldest first."""
    note = F.concat(
        F.col("query_status"),
        F.lit(" · "),
        F.coalesce(F.format_number("tokens_used", 0), F.lit("—")),
        F.lit(" tokens"),
    )
    turns = F.array(
        F.struct(
            F.lit(1).alias("part"),
            F.lit("user").alias("speaker"),
            F.col("user_message").alias("text"),
            F.lit(None).cast("string").alias("note"),
        ),
        F.struct(
            F.lit(2).alias("part"),
            F.lit("bot").alias("speaker"),
            F.col("llm_response").alias("text"),
            note.alias("note"),
        ),
    )
    return history.select(*order, F.inline(turns)).orderBy(*order, "part")


def request_logs(
    request_log: DataFrame, user_id: int | None = None, limit: int | None = None
) -> DataFrame:
    """Request log, newest first; ``limit`` 0 or None means all rows."""
    rows = request_log if user_id is None else request_log.where(F.col("user_id") == user_id)
    rows = rows.orderBy(F.desc("timestamp"), F.desc("log_id"))
    return rows.limit(limit) if limit else rows


def admin_log(request_log: DataFrame) -> DataFrame:
    """Request log lines for operators: success badge and number of trace steps."""
    return request_logs(request_log).select(
        "log_id",
        "timestamp",
        "http_method",
        "endpoint",
        "response_status_code",
        response_label(F.col("response_status_code")).alias("badge"),
        "execution_time_ms",
        trace_length(F.col("backend_trace")).alias("trace_steps"),
    )


def user_dashboard(
    users: DataFrame, usage: DataFrame, plans: DataFrame, query_log: DataFrame
) -> DataFrame:
    """Limits left, counters and history size by status, for every active user.

    The log is counted per user before it meets the dimensions.
    """
    history = (
        query_log.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count("*").alias("history_rows"),
            F.count(F.when(F.col("query_status") == "success", 1)).alias("success_rows"),
            F.count(F.when(F.col("query_status") == "failed", 1)).alias("failed_rows"),
        )
    )
    counters = usage.select("user_id", "hourly_token", "daily_token", "monthly_token")
    return (
        remaining_limits(users, usage, plans)
        .join(counters, "user_id")
        .join(history, "user_id", "left")
        .na.fill(0, ["history_rows", "success_rows", "failed_rows"])
    )
