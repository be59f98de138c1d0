"""Queries over sources, sinks and streams.

Each stages the given tables as landed files, runs its stream in two increments with
``availableNow`` and returns the table the stream wrote. All rows take part; the split decides only
in which increment a row arrives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhouse.functions.schemas import envelope
from meterhouse.operators import replay, shape
from meterhouse.plans.fixtures import Tables
from meterhouse.plans.oracles import using
from meterhouse.plans.queries_events import (
    CHANGE_COLUMNS,
    CHANGE_IMAGE,
    ENVELOPE_SQL,
    TOPIC,
)
from meterhouse.plans.queries_quota import OUTCOME_SQL, gate_sql
from meterhouse.plans.registry import query
from meterhouse.session import work_folder
from meterhouse.sources import changefeed, files, jdbc, tables
from meterhouse.streaming import events as streams
from meterhouse.streaming.history import ChangeHistory
from meterhouse.streaming.metering import MeterStore, meter_stream

MIDDLE = "2024-01-16"


def halves(df: DataFrame, ts: str) -> list[DataFrame]:
    cut = F.lit(MIDDLE).cast("timestamp")
    return [df.where(F.col(ts) < cut), df.where(F.col(ts) >= cut)]


def in_increments(stage, parts: list[DataFrame], run) -> None:
    """Lands each part and runs the stream after it, so that it meets only the new files."""
    for n, part in enumerate(parts):
        stage(part, n)
        run()


# --- batch sources and sinks -----------------------------------------------------------------


@query(
    "src1_snapshot_read",
    using(["users"], "select *, timestamp '2024-02-01' as _snapshot_at from users"),
)
def _(t: Tables) -> DataFrame:
    """What a snapshot read returns; the relational source itself is outside this data set."""
    return jdbc.stamp_snapshot(t.users(), F.lit("2024-02-01").cast("timestamp"))


@query(
    "src2_pull_increment",
    """select event_id, user_id, 10000 as expected, (select max(event_id) from (
         select event_id from events where event_id > 99 order by event_id limit 10000) b)
         as watermark
       from events where event_id > 99 order by event_id limit 10000""",
)
def _(t: Tables) -> DataFrame:
    """One pull of the batch size the exporter uses; the limit is the operator."""
    rows, watermark = jdbc.pull_increment(t.raw("events").select("event_id", "user_id"), "event_id", 99)
    return rows.withColumns(
        {"expected": F.lit(jdbc.PULL_LIMIT), "watermark": F.lit(watermark).cast("bigint")}
    )


@query(
    "src2_pull_everything_new",
    "select event_id, user_id from events where event_id > 99 - 10",
)
def _(t: Tables) -> DataFrame:
    """A pull without a limit that looks ten keys back for late commits."""
    rows, _ = jdbc.pull_increment(
        t.raw("events").select("event_id", "user_id"), "event_id", 99, limit=None, overlap=10
    )
    return rows


@query(
    "src3_land_ndjson",
    """select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, user_id,
         cast(event_type = 'error' as int) as is_error from events""",
)
def _(t: Tables) -> DataFrame:
    root = work_folder(t.spark, "landing")
    rows = t.raw("events").select(
        "event_id", "ts", "user_id", (F.col("event_type") == "error").alias("is_error")
    )
    path = files.land_ndjson(rows, root, "events", "event_id")
    return t.spark.read.schema("event_id bigint, ts string, user_id bigint, is_error int").json(path)


@query(
    "src7_cdc_batch_read",
    using(
        ["user_changes"],
        f"""select 'meter.users' as topic, part as partition, offset_ as offset,
              {ENVELOPE_SQL} as _value from user_changes""",
    ),
)
def _(t: Tables) -> DataFrame:
    path = work_folder(t.spark, "messages")
    t.change_messages().write.parquet(path)
    read = changefeed.read_cdc_batch(t.spark, "parquet", {}, path)
    return shape.cdc_bronze(read).select("topic", "partition", "offset", "_value")


@query("src9_table_read", using(["clean_queries"], "select q_id, user_id, tokens_used from clean_queries"))
def _(t: Tables) -> DataFrame:
    """Silver written and read back for gold."""
    from meterhouse.plans.queries_events import silver_queries

    path = work_folder(t.spark, "silver")
    tables.write_snapshot(silver_queries(t), path)
    return tables.read_table(t.spark, path).select("q_id", "user_id", "tokens_used")


@query(
    "snk1_write_snapshot",
    using(["users"], "select user_id, user_name, (select count(*) from users) as rows_written from users"),
)
def _(t: Tables) -> DataFrame:
    """Written twice with different columns: the second write replaces rows and schema."""
    path = work_folder(t.spark, "snapshot")
    tables.write_snapshot(t.users(), path)
    written = tables.write_snapshot(t.users().select("user_id", "user_name"), path)
    return t.spark.read.parquet(path).withColumn("rows_written", F.lit(written).cast("bigint"))


# --- event file streams ----------------------------------------------------------------------

LOG_SCHEMA = (
    "q_id bigint, user_id int, plan_id int, time_stamp string, query_status string, "
    "tokens_used int, conversation_id string, message_type string"
)


def bronze_queries(t: Tables) -> tuple[str, list]:
    """Query log landed as JSON lines in two increments, each streamed into bronze."""
    landing, bronze = work_folder(t.spark, "landing"), work_folder(t.spark, "bronze")
    runs = []

    def stage(part: DataFrame, n: int) -> None:
        files.land_ndjson(part, landing, "query_log", "q_id")

    def run() -> None:
        lines = files.stream_ndjson(t.spark, f"{landing}/query_log", LOG_SCHEMA)
        rows = shape.with_provenance(lines, "volume_autoloader")
        runs.append(streams.append_stream(rows, f"{bronze}/query_log", f"{bronze}/_ckpt/query_log"))

    in_increments(stage, halves(t.query_log(), "time_stamp"), run)
    return f"{bronze}/query_log", runs


@query(
    "src4_stream_ndjson",
    using(
        ["query_log"],
        """select q_id, user_id, plan_id, strftime(time_stamp, '%Y-%m-%d %H:%M:%S') as time_stamp,
             query_status, tokens_used, conversation_id, message_type,
             'volume_autoloader' as _source_lane from query_log""",
    ),
)
def _(t: Tables) -> DataFrame:
    path, _ = bronze_queries(t)
    return t.spark.read.parquet(path).drop("_ingested_at", "_source_file")


@query(
    "src8_stream_table",
    using(
        ["query_log"],
        f"""select q_id, user_id, tokens_used, time_stamp,
              cast(time_stamp >= timestamp '{MIDDLE}' as int) as run from query_log""",
    ),
)
def _(t: Tables) -> DataFrame:
    """A stream over the table that another stream fills: each run meets the rows of new files only."""
    root = work_folder(t.spark, "stream-table")
    columns = t.query_log().select("q_id", "user_id", "tokens_used", "time_stamp")

    def stage(part: DataFrame, n: int) -> None:
        part.write.parquet(f"{root}/landing/part={n}")
        landed = tables.stream_table(t.spark, f"{root}/landing/*", columns.schema)
        streams.append_stream(landed, f"{root}/bronze", f"{root}/_ckpt/bronze")
        bronze = tables.stream_table(t.spark, f"{root}/bronze", columns.schema)
        read = bronze.withColumn("run", F.lit(n))
        streams.append_stream(read, f"{root}/silver", f"{root}/_ckpt/silver")

    in_increments(stage, halves(columns, "time_stamp"), lambda: None)
    return tables.read_table(t.spark, f"{root}/silver")


@query(
    "snk2_append_stream",
    using(
        ["request_log"],
        f"""select log_id, endpoint,
              case when "timestamp" >= timestamp '{MIDDLE}' then execution_time_ms end
                as execution_time_ms,
              case when "timestamp" >= timestamp '{MIDDLE}' then 1 else 0 end as run,
              (select count(*) from request_log) as rows_written
            from request_log""",
    ),
)
def _(t: Tables) -> DataFrame:
    """Appended in two runs, the second with one more column, then a run that finds nothing to do."""
    root = work_folder(t.spark, "append")
    written = 0
    names = ["log_id", "endpoint", "execution_time_ms"]
    first, second = halves(t.request_log(), "timestamp")
    for n, part in enumerate([first.select(names[:2]), second.select(names), second.select(names).where("false")]):
        part.write.parquet(f"{root}/in/part={n}")
        rows = tables.stream_table(t.spark, f"{root}/in/*", part.schema).withColumn("run", F.lit(n))
        done = streams.append_stream(rows, f"{root}/out", f"{root}/_ckpt")
        written += streams.observed_counts(done).get("rows", 0)
    out = tables.read_table(t.spark, f"{root}/out")
    return out.withColumn("rows_written", F.lit(written).cast("bigint"))


@query(
    "snk3_observed_counts",
    using(
        ["query_log"],
        f"""select cast(time_stamp >= timestamp '{MIDDLE}' as int) as run, count(*) as rows_written,
              count(*) as rows_read from query_log group by 1""",
    ),
)
def _(t: Tables) -> DataFrame:
    """Rows written by each run, from the run's own progress."""
    _, runs = bronze_queries(t)
    rows = [(n, streams.observed_counts(q)["rows"], streams.rows_read(q)) for n, q in enumerate(runs)]
    return t.spark.createDataFrame(rows, "run int, rows_written bigint, rows_read bigint")


def request_lines(t: Tables) -> DataFrame:
    """Requests as JSON lines; the port is a field that nobody declared."""
    status = F.col("response_status_code")

    def line(status: Column) -> Column:
        port = (F.col("log_id") % 9000).alias("port")
        named = status.alias("response_status_code")
        return F.to_json(F.struct("log_id", "request_id", "endpoint", named, port))

    return t.request_log().select(
        F.when(status == 500, line(F.lit("oops"))).otherwise(line(status)).alias("value")
    )


@query(
    "src5_rescue_columns",
    using(
        ["request_log"],
        """select log_id, request_id, endpoint,
             case when response_status_code <> 500 then response_status_code end
               as response_status_code,
             case when response_status_code = 500
               then '{"response_status_code":"oops","port":"' || (log_id % 9000) || '"}'
               else '{"port":"' || (log_id % 9000) || '"}' end as _rescued_data
           from request_log""",
    ),
)
def _(t: Tables) -> DataFrame:
    known = T.StructType.fromDDL(
        "log_id bigint, request_id string, endpoint string, response_status_code int"
    )
    landing, bronze = work_folder(t.spark, "lines"), work_folder(t.spark, "rescued")
    request_lines(t).write.text(landing)
    rows = files.rescue_columns(files.stream_lines(t.spark, landing), known)
    streams.append_stream(rows, f"{bronze}/requests", f"{bronze}/_ckpt")
    return t.spark.read.parquet(f"{bronze}/requests")


@query(
    "src5_evolve_schema",
    using(
        ["request_log"],
        f"""select log_id, endpoint,
              case when "timestamp" >= timestamp '{MIDDLE}' then client_ip end as client_ip
            from request_log""",
    ),
)
def _(t: Tables) -> DataFrame:
    """The second increment brings a new field: one run records it, the next one reads it."""
    root = work_folder(t.spark, "evolving")
    landing, bronze, record = f"{root}/landing", f"{root}/bronze", f"{root}/schema"
    first, second = halves(t.request_log(), "timestamp")
    parts = [first.select("log_id", "endpoint"), second.select("log_id", "endpoint", "client_ip")]
    for part in parts:
        files.land_ndjson(part, landing, "requests", "log_id")
        try:
            schema = files.recorded_schema(t.spark, landing, record)
        except files.SchemaWidened:
            schema = files.recorded_schema(t.spark, landing, record)
        lines = files.stream_ndjson(t.spark, f"{landing}/requests", schema)
        streams.append_stream(lines, f"{bronze}/requests", f"{bronze}/_ckpt")
    return tables.read_table(t.spark, f"{bronze}/requests").select("log_id", "endpoint", "client_ip")


# --- dedup, silver and windowed streams ------------------------------------------------------


def bronze_in_two(t: Tables, df: DataFrame, ts: str, name: str, make) -> str:
    """Runs ``make(stream)`` over a bronze table that grows between two runs."""
    root = work_folder(t.spark, name)
    bronze, out = f"{root}/bronze", f"{root}/out"

    def stage(part: DataFrame, n: int) -> None:
        part.write.parquet(f"{bronze}/part={n}")

    def run() -> None:
        rows = tables.stream_table(t.spark, f"{bronze}/*", df.schema)
        streams.append_stream(make(rows), out, f"{root}/ckpt")

    in_increments(stage, halves(df, ts), run)
    return out


@query("str2_dedup_stream", using(["query_log"], "select distinct * from query_log"))
def _(t: Tables) -> DataFrame:
    out = bronze_in_two(
        t,
        t.query_log(),
        "time_stamp",
        "dedup",
        lambda rows: streams.dedup_stream(rows, ["q_id"], "time_stamp"),
    )
    return t.spark.read.parquet(out)


@query(
    "str1_silver_stream",
    using(
        ["clean_queries"],
        """select q_id, user_id, plan_id, time_stamp as event_ts, query_status, tokens_used,
             conversation_id from clean_queries""",
    ),
)
def _(t: Tables) -> DataFrame:
    out = bronze_in_two(t, t.query_log(), "time_stamp", "silver", streams.silver_query_stream)
    return t.spark.read.parquet(out).select(
        "q_id", "user_id", "plan_id", "event_ts", "query_status", "tokens_used", "conversation_id"
    )


@query(
    "str1_silver_request_stream",
    using(
        ["request_log"],
        """select log_id, request_id, response_status_code as status_code, execution_time_ms,
             "timestamp" as event_ts from request_log where request_id is not null""",
    ),
)
def _(t: Tables) -> DataFrame:
    out = bronze_in_two(t, t.request_log(), "timestamp", "requests", streams.silver_request_stream)
    return t.spark.read.parquet(out).select(
        "log_id", "request_id", "status_code", "execution_time_ms", "event_ts"
    )


@query(
    "agg1_token_usage_stream",
    using(
        ["query_log"],
        """select date_trunc('hour', time_stamp) as usage_hour, user_id, plan_id,
             cast(sum(tokens_used) as bigint) as tokens_used, count(*) as query_count,
             count(case when query_status='failed' then 1 end) as failed_count
           from query_log group by 1, 2, 3
           having date_trunc('hour', min(time_stamp)) + interval 1 hour
             <= (select date_trunc('milliseconds', max(time_stamp)) - interval 1 hour from query_log)""",
    ),
)
def _(t: Tables) -> DataFrame:
    """Hourly windows over the raw log, as far as the watermark has closed them."""
    out = bronze_in_two(
        t,
        t.query_log().withColumnRenamed("time_stamp", "event_ts"),
        "event_ts",
        "hourly",
        streams.hourly_usage_stream,
    )
    return t.spark.read.parquet(out)


@query(
    "agg2_api_slo_stream",
    using(
        ["request_log"],
        """select date_trunc('hour', "timestamp") as usage_hour, endpoint, http_method,
             count(*) as request_count,
             quantile_disc(execution_time_ms, 0.50) as p50_ms,
             quantile_disc(execution_time_ms, 0.95) as p95_ms,
             quantile_disc(execution_time_ms, 0.99) as p99_ms,
             round(100.0::double * count(case when response_status_code >= 400 then 1 end)
                   / count(*), 2) as error_rate_pct
           from request_log where request_id is not null group by 1, 2, 3
           having date_trunc('hour', min("timestamp")) + interval 1 hour
             <= (select date_trunc('milliseconds', max("timestamp")) - interval 1 hour from request_log)""",
    ),
)
def _(t: Tables) -> DataFrame:
    """Hourly service levels over the raw requests, as far as the watermark has closed the hours."""
    out = bronze_in_two(t, t.request_log(), "timestamp", "slo", streams.api_slo_stream)
    return t.spark.read.parquet(out)


@query(
    "str4_late_rows",
    """select count(*) as kept_rows,
         (select count(*) from events
          where ts < (select max(ts) from events) - interval 1 hour) as late_rows
       from events""",
)
def _(t: Tables) -> DataFrame:
    """All events arrive a second time under new ids: those behind the watermark are refused."""
    root = work_folder(t.spark, "late")
    rows = t.events().select("event_id", F.col("ts").alias("event_ts"))
    late = []
    for n, shift in enumerate((0, 1)):
        again = rows.select((F.col("event_id") * 2 + shift).alias("event_id"), "event_ts")
        if shift:
            last = rows.agg(F.max("event_ts") - F.expr("interval 1 hour")).scalar()
            again = again.where(F.col("event_ts") < last)
        again.write.parquet(f"{root}/bronze/part={n}")
        stream = tables.stream_table(t.spark, f"{root}/bronze/*", rows.schema)
        late.append(
            streams.late_rows(
                streams.append_stream(
                    streams.dedup_stream(stream, ["event_id"]), f"{root}/out", f"{root}/ckpt"
                )
            )
        )
    kept = t.spark.read.parquet(f"{root}/out")
    return kept.agg(F.count("*").alias("kept_rows")).withColumn(
        "late_rows", F.lit(late[-1]).cast("bigint")
    )


@query("str5_available_now", "select count(*) as total, count(distinct event_id) as keys from events")
def _(t: Tables) -> DataFrame:
    """One file per micro-batch; the run drains the folder and ends, a second run adds nothing."""
    root = work_folder(t.spark, "drain")
    rows = t.events().select("event_id", "ts")
    rows.repartition(4).write.parquet(f"{root}/in")
    for _ in range(2):
        stream = tables.stream_table(t.spark, f"{root}/in", rows.schema, max_files=1)
        streams.append_stream(stream, f"{root}/out", f"{root}/ckpt")
    return t.spark.read.parquet(f"{root}/out").agg(
        F.count("*").alias("total"), F.count_distinct("event_id").alias("keys")
    )


@query("str6_guard_checkpoint", "select count(*) as total, true as refused from events")
def _(t: Tables) -> DataFrame:
    """A run whose table is there and whose checkpoint is not is refused."""
    root = work_folder(t.spark, "guard")
    rows = t.events().select("event_id", "ts")
    rows.write.parquet(f"{root}/in")
    stream = tables.stream_table(t.spark, f"{root}/in", rows.schema)
    streams.append_stream(stream, f"{root}/out", f"{root}/ckpt")
    refused = False
    try:
        streams.append_stream(stream, f"{root}/out", f"{root}/another-ckpt")
    except streams.CheckpointMismatch:
        refused = True
    return t.spark.read.parquet(f"{root}/out").agg(
        F.count("*").alias("total"), F.lit(refused).alias("refused")
    )


# --- change streams --------------------------------------------------------------------------


def message_halves(t: Tables) -> list[DataFrame]:
    """Odd offsets first: half of all changes arrive out of order."""
    messages = t.change_messages()
    return [messages.where(F.col("offset") % 2 == n) for n in (1, 0)]


@query(
    "src6_cdc_stream",
    using(
        ["user_changes"],
        f"""select 'meter.users' as topic, part as partition, offset_ as offset,
              changed_at as _kafka_ts, '{{"user_id":' || user_id || '}}' as _key,
              {ENVELOPE_SQL} as _value, 'confluent_cdc' as _source_lane from user_changes""",
    ),
)
def _(t: Tables) -> DataFrame:
    """Messages streamed into a bronze table partitioned by topic."""
    root = work_folder(t.spark, "cdc")

    def stage(part: DataFrame, n: int) -> None:
        part.write.parquet(f"{root}/log/part={n}")

    def run() -> None:
        stream = changefeed.read_cdc_stream(t.spark, "parquet", {}, f"{root}/log/*")
        streams.append_stream(
            shape.cdc_bronze(stream), f"{root}/cdc_raw", f"{root}/ckpt", partition_by=["topic"]
        )

    in_increments(stage, message_halves(t), run)
    return t.spark.read.parquet(f"{root}/cdc_raw").drop("_ingested_at")


@query(
    "cdc5_scd2_stream",
    using(
        ["log_history"],
        """select user_id, plan_id, remaining_budget, start_ms as __START_AT, end_ms as __END_AT
           from log_history""",
    ),
)
def _(t: Tables) -> DataFrame:
    """The history of CDC-5, kept by a stream that meets half of the changes too late."""
    root = work_folder(t.spark, "change-stream")
    store = ChangeHistory(f"{root}/store", ["user_id"])

    def stage(part: DataFrame, n: int) -> None:
        part.write.parquet(f"{root}/log/part={n}")

    def run() -> None:
        stream = changefeed.read_cdc_stream(t.spark, "parquet", {}, f"{root}/log/*")
        rows = shape.flatten_changes(
            shape.cdc_bronze(stream), TOPIC, envelope(CHANGE_IMAGE), CHANGE_COLUMNS
        )
        store.run(rows, f"{root}/ckpt")

    in_increments(stage, message_halves(t), run)
    return store.latest(t.spark)


# --- metering --------------------------------------------------------------------------------


@query("str7_meter_stream", gate_sql(OUTCOME_SQL))
def _(t: Tables) -> DataFrame:
    """The gate over a request stream, with counters kept as state between two runs."""
    limits = replay.user_limits(t.users(), t.plans())
    out = bronze_in_two(
        t, t.gate_requests(), "ts", "meter", lambda rows: meter_stream(rows, limits)
    )
    return t.spark.read.parquet(out)


@query("str7_meter_store", gate_sql(OUTCOME_SQL))
def _(t: Tables) -> DataFrame:
    """The same, for batches of any size: counters in a table, every user's requests in pieces."""
    root = work_folder(t.spark, "meter-store")
    df = t.gate_requests()
    pieces = {"long_rows": 0, "piece_rows": max(1, df.count() // 3)}
    store = MeterStore(f"{root}/store", replay.user_limits(t.users(), t.plans()), **pieces)

    def stage(part: DataFrame, n: int) -> None:
        part.write.parquet(f"{root}/bronze/part={n}")

    def run() -> None:
        store.run(tables.stream_table(t.spark, f"{root}/bronze/*", df.schema), f"{root}/ckpt")

    in_increments(stage, halves(df, "ts"), run)
    return store.outcomes(t.spark)
