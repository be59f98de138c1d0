"""Projections: provenance, silver typing, change flattening, masking, spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhouse.functions.columns import (
    event_time,
    is_error,
    mask_ip,
    mask_text,
    pseudonym,
    trace_steps,
)


def with_provenance(
    df: DataFrame, lane: str, files: bool = True, at: Column | None = None
) -> DataFrame:
    """Adds ingestion time, lane and, for file sources, the file each row came from."""
    added = {
        "_ingested_at": F.current_timestamp() if at is None else at,
        "_source_lane": F.lit(lane),
    }
    if files:
        added["_source_file"] = F.col("_metadata.file_path")
    return df.withColumns(added)


def with_missing_as_null(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds every absent column as a typed NULL, so that later selects always resolve."""
    absent = {n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df


# Columns of the silver and bronze tables as name: (source column, type).
QUERY_EVENTS = {
    "q_id": ("q_id", None),
    "user_id": ("user_id", None),
    "plan_id": ("plan_id", None),
    "event_ts": ("time_stamp", "time"),
    "query_status": ("query_status", None),
    "tokens_used": ("tokens_used", "int"),
    "tokens_estimated": ("tokens_estimated", "int"),
    "conversation_id": ("conversation_id", "string"),
    "message_type": ("message_type", "string"),
    "validation_result": ("validation_result", "string"),
    "execution_time_ms": ("execution_time_ms", "int"),
    "is_successful": ("is_successful", "boolean"),
    "_ingested_at": ("_ingested_at", "timestamp"),
}
REQUEST_EVENTS = {
    "log_id": ("log_id", None),
    "request_id": ("request_id", None),
    "user_id": ("user_id", None),
    "http_method": ("http_method", None),
    "endpoint": ("endpoint", None),
    "status_code": ("response_status_code", "int"),
    "execution_time_ms": ("execution_time_ms", "int"),
    "client_ip": ("client_ip", "string"),
    "event_ts": ("timestamp", "time"),
    "_ingested_at": ("_ingested_at", "timestamp"),
}
CHANGE_MESSAGES = {
    "topic": ("topic", None),
    "partition": ("partition", None),
    "offset": ("offset", None),
    "_kafka_ts": ("timestamp", None),
    "_key": ("key", "string"),
    "_value": ("value", "string"),
}
CHANGE_LANE = "confluent_cdc"


def project(df: DataFrame, columns: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Named and typed columns; a value that does not fit its type becomes NULL.

    Columns without a type are required and pass as they are. Absent typed ones are NULL.
    """
    out = []
    for name, (source, kind) in columns.items():
        if kind is None:
            value = F.col(source)
        elif kind == "time":
            value = event_time(df, source)
        elif source in df.columns:
            value = F.col(source).try_cast(kind)
        else:
            value = F.lit(None).cast(kind)
        out.append(value.alias(name))
    return df.select(*out)


def silver_query_events(df: DataFrame) -> DataFrame:
    """Typed query events; message bodies stay behind in bronze."""
    return project(df, QUERY_EVENTS)


def silver_request_events(df: DataFrame) -> DataFrame:
    """Typed request events; an unknown status is neither an error nor a success."""
    return project(df, REQUEST_EVENTS).withColumn("is_error", is_error(F.col("status_code")))


def cdc_bronze(messages: DataFrame, at: Column | None = None) -> DataFrame:
    """Log messages as stored in bronze: addressed and timed, the payload kept as plain text."""
    return with_provenance(project(messages, CHANGE_MESSAGES), CHANGE_LANE, files=False, at=at)


def parse_changes(raw: DataFrame, topic: str, envelope: str) -> DataFrame:
    """One topic of the bronze change table with its envelope parsed once, into ``_msg``."""
    return raw.where(F.col("topic") == topic).withColumn("_msg", F.from_json("_value", envelope))


def flatten_changes(
    raw: DataFrame, topic: str, envelope: str, columns: list[str], drop_tombstones: bool = True
) -> DataFrame:
    """Change rows of one topic: the new image, or on a delete the old one.

    The address (``_part``, ``_offset``) is kept to order changes that share a millisecond.
    """
    parsed = parse_changes(raw, topic, envelope)
    if drop_tombstones:
        parsed = parsed.where(F.col("_value").isNotNull())
    image = F.coalesce(F.col("_msg.after"), F.col("_msg.before"))
    return parsed.select(
        *[image[c].alias(c) for c in columns],
        F.col("_msg.op").alias("_op"),
        F.col("_msg.ts_ms").alias("_ts_ms"),
        F.col("partition").alias("_part"),
        F.col("offset").alias("_offset"),
    )


def drop_shadow_rows(df: DataFrame, rule: str = "conversation") -> DataFrame:
    """Keeps one of the two log rows a metered query leaves.

    ``conversation`` relies on the marker that only the full row carries; ``message_type`` needs
    writers that label the bare row as a procedure call.
    """
    rules = {
        "conversation": F.col("conversation_id").isNotNull(),
        "message_type": F.col("message_type") == "llm_query",
    }
    return df.where(rules[rule])


MASKS = {"text": mask_text, "ip": mask_ip}

# The columns that hold personal data.
PERSONAL_COLUMNS = {"user_message": "text", "llm_response": "text", "client_ip": "ip"}


def mask_columns(
    df: DataFrame, policy: dict[str, str] | None = None, key: str | None = None
) -> DataFrame:
    """Applies a masking kind (``text``, ``ip``, ``hash``) to each named column that is present.

    ``hash`` needs the caller's secret ``key``.
    """
    policy = PERSONAL_COLUMNS if policy is None else policy
    if key is None and "hash" in policy.values():
        raise ValueError("a hash needs a key")
    masked = {
        c: pseudonym(F.col(c), key) if kind == "hash" else MASKS[kind](F.col(c))
        for c, kind in policy.items()
        if c in df.columns
    }
    return df.withColumns(masked) if masked else df


def request_spans(requests: DataFrame, key: str = "request_id") -> DataFrame:
    """One row per trace step, with the time since the step before.

    The gap is taken inside the array, so no row leaves its task.
    """
    steps = trace_steps(F.col("backend_trace"))
    timed = F.transform(
        steps,
        lambda s: F.struct(
            F.try_to_timestamp(s["timestamp"]).alias("step_ts"),
            s["level"].alias("level"),
            s["message"].alias("message"),
        ),
    )
    with_gap = F.transform(
        F.col("_steps"),
        lambda s, i: F.struct(
            (i + 1).alias("step_no"),
            s["step_ts"].alias("step_ts"),
            s["level"].alias("level"),
            s["message"].alias("message"),
            F.when(
                i > 0,
                (
                    F.unix_micros(s["step_ts"])
                    - F.unix_micros(F.get(F.col("_steps"), i - 1)["step_ts"])
                )
                / 1000,
            )
            .cast("bigint")
            .alias("gap_ms"),
        ),
    )
    return (
        requests.select(key, timed.alias("_steps"))
        .select(key, F.inline(with_gap))
    )


def json_params(df: DataFrame, column: str, fields: str) -> DataFrame:
    """Replaces a JSON text column by a struct of the named fields."""
    return df.withColumn(column, F.from_json(column, fields))


def to_json_text(df: DataFrame, column: str) -> DataFrame:
    """The way back: a struct, map or array column as JSON text."""
    return df.withColumn(column, F.to_json(column))


def json_ready(df: DataFrame) -> DataFrame:
    """Casts columns to what an event file holds: binary as text, times as text, booleans as 0/1."""
    out = []
    for field in df.schema.fields:
        col = F.col(field.name)
        if isinstance(field.dataType, T.BinaryType):
            col = F.decode(col, "UTF-8")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.BooleanType):
            col = col.cast("int")
        out.append(col.alias(field.name))
    return df.select(*out)
