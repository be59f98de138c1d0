"""Queries over event tables: projections, quality, deduplication, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterhouse.functions import columns as C
from meterhouse.operators import marts, quality, shape
from meterhouse.operators.dedup import dedup_batch
from meterhouse.plans.fixtures import Tables
from meterhouse.plans.oracles import using
from meterhouse.plans.registry import query
from meterhouse.session import write_and_read

CHANGE_IMAGE = "user_id: int, plan_id: int, remaining_budget: int"
CHANGE_COLUMNS = ["user_id", "plan_id", "remaining_budget"]
TOPIC = "meter.users"


def silver_queries(t: Tables) -> DataFrame:
    """Deduplicated, typed query events of known users."""
    rows = shape.silver_query_events(dedup_batch(t.query_log(), ["q_id"], ["time_stamp"]))
    return quality.expect_or_drop(rows, {"valid_user": "user_id IS NOT NULL"})


def silver_requests(t: Tables) -> DataFrame:
    """Requests with an id, each once although every fifth was delivered twice."""
    log = t.request_log()
    sent = log.unionByName(log.where("log_id % 5 = 0"))
    once = dedup_batch(sent.where("request_id IS NOT NULL"), ["request_id"], ["log_id"])
    rows = shape.silver_request_events(once)
    return quality.expect_or_drop(rows, {"has_request_id": "request_id IS NOT NULL"})


def change_rows(t: Tables) -> DataFrame:
    """``user_changes`` read back out of their envelopes."""
    from meterhouse.functions.schemas import envelope

    bronze = shape.cdc_bronze(t.change_messages())
    return shape.flatten_changes(bronze, TOPIC, envelope(CHANGE_IMAGE), CHANGE_COLUMNS)


# --- projections -----------------------------------------------------------------------------


@query(
    "prj1_provenance",
    """select event_id, timestamp '2024-02-01' as _ingested_at, 'volume_autoloader' as _source_lane,
         true as has_file from events""",
)
def _(t: Tables) -> DataFrame:
    at = F.lit("2024-02-01").cast("timestamp")
    rows = shape.with_provenance(t.raw("events").select("event_id", "_metadata"), "volume_autoloader", at=at)
    return rows.select(
        "event_id", "_ingested_at", "_source_lane", F.col("_source_file").contains("events").alias("has_file")
    )


@query(
    "prj2_silver_query_events",
    using(
        ["query_log"],
        """select q_id, user_id, plan_id, time_stamp as event_ts, query_status, tokens_used,
             cast(null as int) as tokens_estimated, conversation_id, message_type,
             cast(null as varchar) as validation_result, cast(null as int) as execution_time_ms,
             cast(null as boolean) as is_successful from query_log""",
    ),
)
def _(t: Tables) -> DataFrame:
    return shape.silver_query_events(t.query_log()).drop("_ingested_at")


@query(
    "prj3_silver_request_events",
    using(
        ["request_log"],
        """select log_id, request_id, user_id, http_method, endpoint,
             response_status_code as status_code, response_status_code >= 400 as is_error,
             execution_time_ms, client_ip, "timestamp" as event_ts from request_log""",
    ),
)
def _(t: Tables) -> DataFrame:
    return shape.silver_request_events(t.request_log()).drop("_ingested_at")


@query(
    "prj4_missing_as_null",
    using(
        ["query_log"],
        """select q_id, tokens_used, cast(null as int) as tokens_estimated,
             cast(null as varchar) as validation_result from query_log""",
    ),
)
def _(t: Tables) -> DataFrame:
    rows = t.query_log().select("q_id", "tokens_used")
    return shape.with_missing_as_null(
        rows, {"tokens_used": "int", "tokens_estimated": "int", "validation_result": "string"}
    )


@query(
    "prj5_flatten_changes",
    using(
        ["user_changes"],
        """select user_id, plan_id, remaining_budget, op as _op, epoch_ms(changed_at) as _ts_ms,
             part as _part, offset_ as _offset from user_changes""",
    ),
)
def _(t: Tables) -> DataFrame:
    return change_rows(t)


ENVELOPE_SQL = """
  case when op='d'
    then '{"before":{"user_id":' || user_id || ',"plan_id":' || plan_id || ',"remaining_budget":'
         || remaining_budget || '},"op":"d","ts_ms":' || epoch_ms(changed_at) || '}'
    else '{"after":{"user_id":' || user_id || ',"plan_id":' || plan_id || ',"remaining_budget":'
         || remaining_budget || '},"op":"u","ts_ms":' || epoch_ms(changed_at) || '}' end"""


@query(
    "prj6_cdc_bronze",
    using(
        ["user_changes"],
        f"""select 'meter.users' as topic, part as partition, offset_ as offset,
             changed_at as _kafka_ts, '{{"user_id":' || user_id || '}}' as _key,
             {ENVELOPE_SQL} as _value, 'confluent_cdc' as _source_lane from user_changes""",
    ),
)
def _(t: Tables) -> DataFrame:
    return shape.cdc_bronze(t.change_messages()).drop("_ingested_at")


@query(
    "prj7_drop_shadow_rows",
    using(["clean_queries"], "select * from clean_queries where conversation_id is not null"),
)
def _(t: Tables) -> DataFrame:
    rows = dedup_batch(t.query_log(), ["q_id"], ["time_stamp"]).where("user_id IS NOT NULL")
    return shape.drop_shadow_rows(rows)


@query(
    "prj9_mask_columns",
    """select doc_id,
         regexp_replace(regexp_replace(regexp_replace(text, '[\\p{Ll}\\p{Lm}\\p{Lo}\\p{M}]', 'x', 'g'),
           '[\\p{Lu}\\p{Lt}]', 'X', 'g'), '\\p{N}', 'n', 'g') as user_message,
         case doc_id % 3 when 0 then '10.0.' || doc_id % 200 || '.0'
           when 1 then '2001:db8:' || doc_id % 9000 || '::' else '2001:db8::' end as client_ip,
         sha256('key' || sha256('key' || text)) as fingerprint
       from documents""",
)
def _(t: Tables) -> DataFrame:
    """Texts in four languages, and addresses of both kinds."""
    doc = F.col("doc_id")
    rows = t.raw("documents").select(
        "doc_id",
        F.col("text").alias("user_message"),
        F.when(doc % 3 == 0, F.concat(F.lit("10.0."), doc % 200, F.lit("."), doc % 250))
        .when(doc % 3 == 1, F.concat(F.lit("2001:db8:"), doc % 9000, F.lit(":1:2:3:4:5")))
        .otherwise(F.concat(F.lit("2001:db8::"), doc % 9000))
        .alias("client_ip"),
        F.col("text").alias("fingerprint"),
    )
    return shape.mask_columns(rows, {**shape.PERSONAL_COLUMNS, "fingerprint": "hash"}, "key")


@query(
    "prj10_response_label",
    using(
        ["request_log"],
        """select log_id, case when response_status_code < 400 then 'OK' else 'Error' end as label
           from request_log""",
    ),
)
def _(t: Tables) -> DataFrame:
    return t.request_log().select(
        "log_id", C.response_label(F.col("response_status_code")).alias("label")
    )


@query(
    "prj11_json_fields",
    """select event_id, cast(json_extract(props, '$.k') as int) as k,
         '{"k":' || cast(json_extract(props, '$.k') as int) || '}' as params from events""",
)
def _(t: Tables) -> DataFrame:
    rows = shape.json_params(t.raw("events").select("event_id", "props"), "props", "k int")
    return shape.to_json_text(
        rows.select("event_id", F.col("props.k").alias("k"), F.col("props").alias("params")),
        "params",
    )


@query(
    "prj12_request_spans",
    using(
        ["traces"],
        """select request_id, 1 as step_no, timestamp '2024-01-01 00:00:00' as step_ts,
             'INFO' as level, 'START' as message, cast(null as bigint) as gap_ms from traces
           union all
           select request_id, 2, timestamp '2024-01-01 00:00:01', last_level, 'END', 1000
           from traces""",
    ),
)
def _(t: Tables) -> DataFrame:
    return shape.request_spans(t.traces())


WORDS_SQL = "len(regexp_extract_all(text, '[^\\s\\x0B\\x1C-\\x1F\\x{85}\\p{Z}]+'))"


@query(
    "prj13_estimate_tokens",
    f"""select 'conversation' as origin, conv_id as id, turn,
          cast(greatest(50, 10*{WORDS_SQL}) as int) as tokens_estimated from conversations
        union all
        select 'document', doc_id, 0, cast(greatest(50, 10*{WORDS_SQL}) as int) from documents""",
)
def _(t: Tables) -> DataFrame:
    talks = t.raw("conversations").select(
        F.lit("conversation").alias("origin"), F.col("conv_id").alias("id"), "turn", "text"
    )
    docs = t.raw("documents").select(
        F.lit("document").alias("origin"),
        F.col("doc_id").alias("id"),
        F.lit(0).cast("bigint").alias("turn"),
        "text",
    )
    both = talks.unionByName(docs)
    return both.select(
        "origin", "id", "turn", C.estimate_tokens(F.col("text")).alias("tokens_estimated")
    )


@query(
    "prj14_filters",
    using(
        ["query_log", "users"],
        """select q.q_id, q.user_id, q.tokens_used from query_log q
           join users u on u.user_id = q.user_id
           where u.is_active and q.message_type = 'llm_query' and q.query_status = 'failed'""",
    ),
)
def _(t: Tables) -> DataFrame:
    active = t.users().where("is_active").select("user_id")
    return (
        t.query_log()
        .where("message_type = 'llm_query' and query_status = 'failed'")
        .join(active, "user_id", "left_semi")
        .select("q_id", "user_id", "tokens_used")
    )


# --- data quality ----------------------------------------------------------------------------


@query(
    "dq1_expect",
    using(
        ["request_log"],
        """select 'latency_sane' as rule, count(*) as rows_in,
             cast(sum(case when execution_time_ms is null
                        or execution_time_ms between 0 and 300000 then 0 else 1 end) as bigint)
               as rows_failed, count(*) as rows_out
           from request_log""",
    ),
)
def _(t: Tables) -> DataFrame:
    """All rows stay; the violations are counted while they are written."""
    from pyspark.sql import Observation

    seen = Observation()
    rules = {"latency_sane": quality.REQUEST_EVENT_RULES["latency_sane"][1]}
    kept = quality.expect(shape.silver_request_events(t.request_log()), rules, seen)
    stored = write_and_read(kept.select("log_id"), "expect")
    counts = seen.get
    return stored.agg(F.count("*").alias("rows_out")).select(
        F.lit("latency_sane").alias("rule"),
        F.lit(counts["rows_in"]).cast("bigint").alias("rows_in"),
        F.lit(counts["latency_sane"]).cast("bigint").alias("rows_failed"),
        "rows_out",
    )


@query(
    "dq2_expect_or_drop",
    using(
        ["request_log"],
        "select log_id, request_id from request_log where request_id is not null",
    ),
)
def _(t: Tables) -> DataFrame:
    return silver_requests(t).select("log_id", "request_id")


@query(
    "dq3_expect_or_fail",
    "select event_id from events",
)
def _(t: Tables) -> DataFrame:
    rules = {"has_key": "event_id IS NOT NULL", "has_time": "ts IS NOT NULL"}
    return quality.expect_or_fail(t.events(), rules).select("event_id")


@query(
    "dq4_null_is_violation",
    using(
        ["query_log"],
        """select q_id, user_id, tokens_used from query_log where tokens_used >= 0""",
    ),
)
def _(t: Tables) -> DataFrame:
    """A rule that does not mention NULL drops the rows where it is NULL."""
    rows = quality.expect_or_drop(t.query_log(), {"tokens": "tokens_used >= 0"})
    return rows.select("q_id", "user_id", "tokens_used")


@query(
    "dq5_quality_report",
    using(
        ["query_log", "request_log"],
        """select 'valid_user' as rule, 'drop' as action, count(*) as rows_in,
             count(case when user_id is null then 1 end) as rows_failed from query_log
           union all
           select 'non_negative_tokens', 'warn', count(*),
             count(case when tokens_used < 0 then 1 end) from query_log
           union all
           select 'not_future_dated', 'warn', count(*),
             count(case when time_stamp > now() then 1 end) from query_log
           union all
           select 'has_request_id', 'drop', count(*),
             count(case when request_id is null then 1 end) from request_log
           union all
           select 'latency_sane', 'warn', count(*),
             count(case when execution_time_ms not between 0 and 300000 then 1 end)
           from request_log""",
    ),
)
def _(t: Tables) -> DataFrame:
    queries = shape.silver_query_events(t.query_log())
    requests = shape.silver_request_events(t.request_log())
    return quality.quality_report(queries, quality.QUERY_EVENT_RULES).unionByName(
        quality.quality_report(requests, quality.REQUEST_EVENT_RULES)
    )


@query(
    "dq6_check_constraints",
    using(
        ["query_log", "users", "plans"],
        """select q_id, count(*) as copies, reasons from (
             select l.q_id, concat_ws(',',
               case when l.user_id is not null and u.user_id is null then 'foreign:user_id' end,
               case when d.q_id is not null then 'unique:q_id' end) as reasons
             from (select q_id, plan_id, case when user_id >= 100 then user_id + 100000
                                         else user_id end as user_id from query_log) l
             left join users u on u.user_id = l.user_id
             left join (select q_id from query_log group by q_id having count(*) > 1) d
               on d.q_id = l.q_id) x
           where reasons <> '' group by q_id, reasons""",
    ),
)
def _(t: Tables) -> DataFrame:
    """Quarantined log rows: repeated ids, and users moved out of the dimension's range."""
    moved = t.query_log().withColumn(
        "user_id",
        F.when(F.col("user_id") >= 100, F.col("user_id") + 100000).otherwise(F.col("user_id")),
    )
    _, bad = quality.check_constraints(
        moved, quality.QUERY_LOG_CONSTRAINTS, {"users": t.users(), "plans": t.plans()}
    )
    return bad.groupBy("q_id", F.array_join("_violations", ",").alias("reasons")).agg(
        F.count("*").alias("copies")
    )


@query(
    "dq6_constraints_kept",
    using(
        ["query_log", "users"],
        """select l.* from query_log l
           where l.q_id not in (select q_id from query_log group by q_id having count(*) > 1)
             and (l.user_id is null or l.user_id in (select user_id from users))""",
    ),
)
def _(t: Tables) -> DataFrame:
    ok, _ = quality.check_constraints(
        t.query_log(), quality.QUERY_LOG_CONSTRAINTS, {"users": t.users(), "plans": t.plans()}
    )
    return ok


@query(
    "dq7_envelope_health",
    using(
        ["user_changes"],
        """select 'meter.users' as topic, count(*) as messages,
             count(case when offset_%5=0 then 1 end) as tombstones,
             count(case when offset_%5=1 then 1 end) as unparsed,
             count(case when offset_%5=2 then 1 end) as missing_key,
             count(case when offset_%5=3 then 1 end) as null_fields
           from user_changes""",
    ),
)
def _(t: Tables) -> DataFrame:
    """Messages with every kind of fault, told apart by their offset."""
    from meterhouse.functions.schemas import envelope

    bronze = shape.cdc_bronze(t.change_messages())
    kind = F.col("offset") % 5
    faulty = bronze.withColumn(
        "_value",
        F.when(kind == 1, F.lit("not json"))
        .when(kind == 2, F.regexp_replace("_value", r'"user_id":\d+', '"user_id":"x"'))
        .when(kind == 3, F.regexp_replace("_value", r'"plan_id":\d+', '"plan_id":true'))
        .when(kind == 4, F.col("_value")),
    )
    return quality.envelope_health(
        shape.parse_changes(faulty, TOPIC, envelope(CHANGE_IMAGE)), ["user_id"]
    )


@query(
    "dq8_audit_increment",
    using(
        ["request_log"],
        """select count(case when "timestamp" < timestamp '2024-01-16' then 1 end) as rows_before,
             count(case when "timestamp" >= timestamp '2024-01-16' then 1 end) as rows_new,
             count(*) as rows_after, 0 as repeated_keys, 0 as missing_keys, 0 as foreign_keys,
             true as is_exact
           from request_log""",
    ),
)
def _(t: Tables) -> DataFrame:
    log = t.request_log()
    split = F.lit("2024-01-16").cast("timestamp")
    before, new = log.where(F.col("timestamp") < split), log.where(F.col("timestamp") >= split)
    return quality.audit_increment(before, before.unionByName(new), new, "log_id")


@query(
    "dq9_double_write_report",
    using(
        ["query_log"],
        """select cast(sum(bare + whole) as bigint) as rows_total,
             cast(sum(least(bare, whole)) as bigint) as twin_pairs,
             cast(sum((bare + whole) * tokens_used) as bigint) as tokens_logged,
             cast(sum((bare + whole - least(bare, whole)) * tokens_used) as bigint) as tokens_net,
             round(sum((bare + whole) * tokens_used) * 1.0::double
                   / sum((bare + whole - least(bare, whole)) * tokens_used), 4) as inflation
           from (select user_id, time_stamp, tokens_used,
                   count(case when conversation_id is null then 1 end) as bare,
                   count(conversation_id) as whole
                 from query_log where tokens_used is not null
                 group by user_id, time_stamp, tokens_used) g""",
    ),
)
def _(t: Tables) -> DataFrame:
    return quality.double_write_report(t.query_log())


# --- deduplication ---------------------------------------------------------------------------


@query("str3_dedup_batch", using(["query_log"], "select distinct * from query_log"))
def _(t: Tables) -> DataFrame:
    return dedup_batch(t.query_log(), ["q_id"], ["time_stamp"])


# --- aggregates ------------------------------------------------------------------------------


@query(
    "agg1_token_usage_hourly",
    using(
        ["clean_queries"],
        """select date_trunc('hour', time_stamp) as usage_hour, user_id, plan_id,
             cast(sum(tokens_used) as bigint) as tokens_used, count(*) as query_count,
             count(case when query_status='failed' then 1 end) as failed_count
           from clean_queries group by 1, 2, 3""",
    ),
)
def token_usage(t: Tables) -> DataFrame:
    return marts.token_usage_hourly(silver_queries(t))


@query(
    "agg1_token_usage_billed",
    using(
        ["clean_queries"],
        """select date_trunc('hour', time_stamp) as usage_hour, user_id, plan_id,
             cast(sum(case when query_status='failed' then 0 else tokens_used end) as bigint)
               as tokens_used,
             count(*) as query_count, count(case when query_status='failed' then 1 end)
               as failed_count
           from clean_queries where conversation_id is not null group by 1, 2, 3""",
    ),
)
def _(t: Tables) -> DataFrame:
    return marts.token_usage_hourly(silver_queries(t), "billed")


@query(
    "agg2_api_slo_hourly",
    using(
        ["request_log"],
        """select date_trunc('hour', "timestamp") as usage_hour, endpoint, http_method,
             count(*) as request_count,
             quantile_disc(execution_time_ms, 0.50) as p50_ms,
             quantile_disc(execution_time_ms, 0.95) as p95_ms,
             quantile_disc(execution_time_ms, 0.99) as p99_ms,
             round(100.0::double * count(case when response_status_code >= 400 then 1 end)
                   / count(*), 2) as error_rate_pct
           from request_log where request_id is not null group by 1, 2, 3""",
    ),
)
def api_slo(t: Tables) -> DataFrame:
    return marts.api_slo_hourly(silver_requests(t))


@query(
    "agg3_latency_percentiles",
    using(
        ["request_log"],
        """select user_id, quantile_disc(execution_time_ms, 0.50) as p50_ms,
             quantile_disc(execution_time_ms, 0.95) as p95_ms,
             quantile_disc(execution_time_ms, 0.99) as p99_ms
           from request_log group by user_id""",
    ),
)
def _(t: Tables) -> DataFrame:
    return t.request_log().groupBy("user_id").agg(*marts.latency_percentiles("execution_time_ms"))


@query(
    "agg4_plan_utilisation",
    using(
        ["clean_queries", "plan_history"],
        """select plan_id, usage_day, count(*) as active_users,
             cast(sum(tokens) as bigint) as tokens_used,
             cast(sum(daily_limit) as bigint) as token_capacity,
             round(100.0::double * sum(tokens) / sum(daily_limit), 4) as utilisation_pct
           from (
             select q.plan_id, date_trunc('day', q.time_stamp) as usage_day, q.user_id,
               sum(q.tokens_used) as tokens, arg_max(h.daily_token_limit, q.time_stamp)
                 as daily_limit
             from clean_queries q left join plan_history h on h.plan_id = q.plan_id
               and h.start_at <= q.time_stamp
               and (h.end_at is null or q.time_stamp < h.end_at)
             group by 1, 2, 3) x
           group by 1, 2""",
    ),
)
def _(t: Tables) -> DataFrame:
    return marts.plan_utilisation(silver_queries(t), plan_history(t))


@query(
    "agg6_hourly_overruns",
    using(
        ["clean_queries", "plan_history"],
        """select *, tokens_used - hourly_token_limit as excess from (
             select q.user_id, q.plan_id, date_trunc('hour', q.time_stamp) as usage_hour,
               cast(sum(q.tokens_used) as bigint) as tokens_used,
               max(h.hourly_token_limit) as hourly_token_limit
             from clean_queries q join plan_history h on h.plan_id = q.plan_id
               and h.start_at <= q.time_stamp
               and (h.end_at is null or q.time_stamp < h.end_at)
             group by 1, 2, 3) x
           where tokens_used > hourly_token_limit""",
    ),
)
def _(t: Tables) -> DataFrame:
    return marts.hourly_overruns(silver_queries(t), plan_history(t))


def plan_history(t: Tables) -> DataFrame:
    """SCD2 of the plans, derived from their snapshots."""
    from meterhouse.operators.history import scd2_from_snapshots

    return scd2_from_snapshots(t.plan_versions(), ["plan_id"], "start_at")



