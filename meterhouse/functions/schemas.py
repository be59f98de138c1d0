"""Declared schemas of the source tables, event files and change envelopes."""

# Column names and types of the metering data model.
PLAN_COLUMNS = (
    "plan_id int, plan_name string, hourly_token_limit int, "
    "daily_token_limit int, monthly_token_limit int, is_active boolean"
)
USER_COLUMNS = (
    "user_id int, user_name string, plan_id int, token_budget int, "
    "remaining_budget int, is_active boolean"
)
USAGE_COLUMNS = (
    "user_id int, hourly_token int, hourly_session_start timestamp, "
    "daily_token int, daily_session_start timestamp, "
    "monthly_token int, monthly_session_start timestamp"
)
QUERY_LOG_COLUMNS = (
    "q_id bigint, user_id int, plan_id int, time_stamp timestamp, query_status string, "
    "tokens_used int, conversation_id string, user_message string, llm_response string, "
    "message_type string, allow_budget_override boolean, validation_result string, "
    "tokens_estimated int, execution_time_ms int, is_successful boolean"
)
REQUEST_LOG_COLUMNS = (
    "log_id bigint, request_id string, user_id int, http_method string, endpoint string, "
    "request_params string, response_status_code int, response_message string, "
    "backend_trace string, execution_time_ms int, client_ip string, timestamp timestamp"
)
TRACE_ELEMENT = "array<struct<timestamp: string, level: string, message: string>>"

# A change message's row image carries booleans as 0/1 integers.
USER_IMAGE = (
    "user_id: int, user_name: string, plan_id: int, "
    "token_budget: int, remaining_budget: int, is_active: int"
)
PLAN_IMAGE = (
    "plan_id: int, plan_name: string, hourly_token_limit: int, "
    "daily_token_limit: int, monthly_token_limit: int, is_active: int"
)

# Allowed members and defaults of the log columns.
QUERY_STATUSES = ["success", "failed"]
MESSAGE_TYPES = ["llm_query", "validation_check", "budget_check", "procedure_exec"]
QUERY_LOG_DEFAULTS = {
    "message_type": "llm_query",
    "allow_budget_override": False,
    "is_successful": True,
}

# Operation codes of a change message.
CHANGE_OPS = {"r": "read", "c": "create", "u": "update", "d": "delete"}


def envelope(row_image: str) -> str:
    """The change message type around a row image."""
    return f"struct<before: struct<{row_image}>, after: struct<{row_image}>, op: string, ts_ms: bigint>"


def names_of(ddl: str) -> list[str]:
    return [part.split()[0].rstrip(":") for part in ddl.split(", ")]
