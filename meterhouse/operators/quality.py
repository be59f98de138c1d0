"""Data-quality rules, reports, constraints and audits.

A rule is a SQL condition. A row violates it when the condition is false *or NULL*; rules that
accept NULL say so themselves.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The rules of the two silver event tables.
QUERY_EVENT_RULES = {
    "valid_user": ("drop", "user_id IS NOT NULL"),
    "non_negative_tokens": ("warn", "tokens_used IS NULL OR tokens_used >= 0"),
    "not_future_dated": ("warn", "event_ts <= current_timestamp()"),
}
REQUEST_EVENT_RULES = {
    "has_request_id": ("drop", "request_id IS NOT NULL"),
    "latency_sane": (
        "warn",
        "execution_time_ms IS NULL OR execution_time_ms BETWEEN 0 AND 300000",
    ),
}


def holds(condition: str) -> Column:
    return F.coalesce(F.expr(condition), F.lit(False))


def _violations(rules: dict[str, str]) -> list[Column]:
    return [F.count(F.when(~holds(c), 1)).alias(n) for n, c in rules.items()]


def _observe(df: DataFrame, rules: dict[str, str], observation) -> DataFrame:
    if observation is None:
        return df
    return df.observe(observation, F.count(F.lit(1)).alias("rows_in"), *_violations(rules))


def expect(df: DataFrame, rules: dict[str, str], observation: Observation | str | None) -> DataFrame:
    """Keeps all rows; violations are counted in the pass that writes them.

    ``observation`` is an ``Observation`` in batch and a name in a stream, where the counts appear
    in the query progress.
    """
    return _observe(df, rules, observation)


def expect_or_drop(
    df: DataFrame, rules: dict[str, str], observation: Observation | str | None = None
) -> DataFrame:
    """Counts violations, then drops the violating rows."""
    keep = reduce(lambda a, b: a & b, [holds(c) for c in rules.values()])
    return _observe(df, rules, observation).where(keep)


def expect_or_fail(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Aborts the job at the first violating row."""
    for name, condition in rules.items():
        checked = F.when(holds(condition), F.lit(True)).otherwise(
            F.raise_error(F.lit(f"expectation {name} violated")).cast("boolean")
        )
        df = df.where(checked)
    return df


def apply_rules(
    df: DataFrame, rules: dict[str, tuple[str, str]], observation: Observation | str | None = None
) -> DataFrame:
    """Applies a mixed rule set: ``warn`` counts, ``drop`` filters, ``fail`` aborts."""
    by_action: dict[str, dict[str, str]] = {"warn": {}, "drop": {}, "fail": {}}
    for name, (action, condition) in rules.items():
        by_action[action][name] = condition
    out = _observe(df, {n: c for n, (_, c) in rules.items()}, observation)
    if by_action["fail"]:
        out = expect_or_fail(out, by_action["fail"])
    return expect_or_drop(out, by_action["drop"]) if by_action["drop"] else out


def quality_report(df: DataFrame, rules: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per rule: action, rows in, rows failed. One pass, one row per task is shuffled."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows_in"), *_violations({n: c for n, (_, c) in rules.items()})
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(n).alias("rule"),
                F.lit(a).alias("action"),
                F.col("rows_in").cast("bigint").alias("rows_in"),
                F.col(n).cast("bigint").alias("rows_failed"),
            )
            for n, (a, _) in rules.items()
        ]
    )
    return counted.select(F.inline(lines))


@dataclass
class Constraints:
    """Declared constraints of one table."""

    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    positive: list[str] = field(default_factory=list)
    members: dict[str, list] = field(default_factory=dict)
    foreign: dict[str, tuple[str, str]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)


# Constraints of the source tables.
PLAN_CONSTRAINTS = Constraints(
    not_null=["plan_name", "is_active"],
    unique=["plan_id", "plan_name"],
    positive=["hourly_token_limit", "daily_token_limit", "monthly_token_limit"],
    defaults={
        "hourly_token_limit": 1000,
        "daily_token_limit": 10000,
        "monthly_token_limit": 100000,
        "is_active": True,
    },
)
USER_CONSTRAINTS = Constraints(
    not_null=["user_name", "plan_id", "token_budget", "remaining_budget", "is_active"],
    unique=["user_id", "user_name"],
    positive=["token_budget", "remaining_budget"],
    foreign={"plan_id": ("plans", "plan_id")},
    defaults={"token_budget": 100, "remaining_budget": 100, "is_active": True},
)
QUERY_LOG_CONSTRAINTS = Constraints(
    not_null=["q_id"],
    unique=["q_id"],
    members={
        "query_status": ["success", "failed"],
        "message_type": ["llm_query", "validation_check", "budget_check", "procedure_exec"],
    },
    foreign={"user_id": ("users", "user_id"), "plan_id": ("plans", "plan_id")},
    defaults={"message_type": "llm_query"},
)


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    present = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in df.columns}
    return df.withColumns(present) if present else df


def broken_reference(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-NULL ``column`` has no parent row."""
    keys = parent.select(F.col(parent_key).alias(column)).distinct()
    return df.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def with_violations(
    df: DataFrame, spec: Constraints, refs: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Adds ``_violations``, the sorted names of all constraints a row breaks.

    NULL passes CHECK, UNIQUE, member and reference rules, as in SQL. Repeats are found by a
    partial count per key; only the keys that repeat are joined back.
    """
    df = fill_defaults(df, spec.defaults)
    found: list[Column] = []
    for c in spec.not_null:
        found.append(F.when(F.col(c).isNull(), F.lit(f"not_null:{c}")))
    for c in spec.positive:
        found.append(F.when(F.col(c) <= 0, F.lit(f"positive:{c}")))
    for c, allowed in spec.members.items():
        found.append(F.when(~F.col(c).isin(allowed), F.lit(f"member:{c}")))
    helpers: list[str] = []
    base = df
    for c in spec.unique:
        flag = f"_dup_{c}"
        repeated = (
            base.where(F.col(c).isNotNull())
            .groupBy(c)
            .agg(F.count("*").alias("_n"))
            .where("_n > 1")
            .select(c, F.lit(True).alias(flag))
        )
        df = df.join(repeated, c, "left")
        found.append(F.when(F.col(flag), F.lit(f"unique:{c}")))
        helpers.append(flag)
    for c, (table, key) in spec.foreign.items():
        flag = f"_ref_{c}"
        parent = (refs or {})[table].select(F.col(key).alias(c)).distinct()
        df = df.join(parent.withColumn(flag, F.lit(True)), c, "left")
        found.append(
            F.when(F.col(c).isNotNull() & F.col(flag).isNull(), F.lit(f"foreign:{c}"))
        )
        helpers.append(flag)
    names = F.array_sort(F.array_compact(F.array(*found)))
    return df.withColumn("_violations", names).drop(*helpers)


def check_constraints(
    df: DataFrame, spec: Constraints, refs: dict[str, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Splits a batch into rows that pass and rows for quarantine, the latter with the reasons."""
    flagged = with_violations(df, spec, refs)
    ok = flagged.where(F.size("_violations") == 0).drop("_violations")
    return ok, flagged.where(F.size("_violations") > 0)


def envelope_health(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """Per topic: messages, tombstones, unparsed payloads, missing keys and NULL fields.

    Takes the output of ``parse_changes``. A message with a value but no struct, no operation or no
    key was declared with the wrong type; a NULL value is a tombstone, not a fault.
    """
    present = F.col("_value").isNotNull()
    image = F.coalesce(F.col("_msg.after"), F.col("_msg.before"))
    unparsed = present & (F.col("_msg").isNull() | F.col("_msg.op").isNull())
    no_key = reduce(lambda a, b: a | b, [image[k].isNull() for k in keys])
    image_type = parsed.schema["_msg"].dataType["after"].dataType
    null_fields = reduce(lambda a, b: a | b, [image[f].isNull() for f in image_type.names])

    def count_if(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    return parsed.groupBy("topic").agg(
        F.count("*").alias("messages"),
        count_if(~present).alias("tombstones"),
        count_if(unparsed).alias("unparsed"),
        count_if(present & ~unparsed & no_key).alias("missing_key"),
        count_if(present & ~unparsed & ~no_key & null_fields).alias("null_fields"),
    )


def audit_increment(
    before: DataFrame, after: DataFrame, new: DataFrame, key: str
) -> DataFrame:
    """Did the table grow by exactly the new rows, once each? One row with the evidence.

    Every key is counted in one shuffle over the three inputs tagged by origin.
    """
    tagged = (
        before.select(key, F.lit(1).alias("b"), F.lit(0).alias("a"), F.lit(0).alias("n"))
        .unionByName(after.select(key, F.lit(0).alias("b"), F.lit(1).alias("a"), F.lit(0).alias("n")))
        .unionByName(new.select(key, F.lit(0).alias("b"), F.lit(0).alias("a"), F.lit(1).alias("n")))
    )
    per_key = tagged.groupBy(key).agg(
        F.sum("b").alias("b"), F.sum("a").alias("a"), F.sum("n").alias("n")
    )
    return per_key.agg(
        F.sum("b").alias("rows_before"),
        F.sum("n").alias("rows_new"),
        F.sum("a").alias("rows_after"),
        F.count(F.when(F.col("a") > 1, 1)).alias("repeated_keys"),
        F.count(F.when((F.col("n") > 0) & (F.col("a") == 0), 1)).alias("missing_keys"),
        F.count(F.when((F.col("a") > 0) & (F.col("b") + F.col("n") == 0), 1)).alias("foreign_keys"),
    ).withColumn(
        "is_exact",
        (F.col("rows_after") == F.col("rows_before") + F.col("rows_new"))
        & (F.col("repeated_keys") == 0)
        & (F.col("missing_keys") == 0)
        & (F.col("foreign_keys") == 0),
    )


def double_write_report(query_log: DataFrame) -> DataFrame:
    """How much the bare twin rows inflate the token sum.

    A twin pair shares user, time and tokens; one row names a conversation, the other does not.
    """
    groups = (
        query_log.where(F.col("tokens_used").isNotNull())
        .groupBy("user_id", "time_stamp", "tokens_used")
        .agg(
            F.count(F.when(F.col("conversation_id").isNull(), 1)).alias("bare"),
            F.count(F.when(F.col("conversation_id").isNotNull(), 1)).alias("full"),
        )
        .withColumn("pairs", F.least("bare", "full"))
    )
    return groups.agg(
        F.sum(F.col("bare") + F.col("full")).alias("rows_total"),
        F.sum("pairs").alias("twin_pairs"),
        F.sum((F.col("bare") + F.col("full")) * F.col("tokens_used")).alias("tokens_logged"),
        F.sum((F.col("bare") + F.col("full") - F.col("pairs")) * F.col("tokens_used")).alias(
            "tokens_net"
        ),
    ).withColumn("inflation", F.round(F.col("tokens_logged") / F.col("tokens_net"), 4))
