"""Streams run in increments and are compared with their batch twins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterhouse.operators import history, marts, quality, shape
from meterhouse.operators.dedup import dedup_batch
from meterhouse.plans.lanes import Lakehouse
from meterhouse.sources import tables as T
from meterhouse.streaming import events as streams

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_dedup_within_and_beyond_the_watermark(spark, tmp_path):
    root = str(tmp_path)
    batches = [
        [(1, at(0)), (1, at(5)), (2, at(10))],
        [(1, at(30)), (3, at(300))],  # a repeat inside the watermark; then time moves on
        [(4, at(20)), (1, at(310))],  # too late; a repeat of a key whose state is gone
    ]
    late = 0
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, "id int, ts timestamp").write.parquet(f"{root}/in/part={n}")
        stream = T.stream_table(spark, f"{root}/in/*", "id int, ts timestamp")
        query = streams.append_stream(
            streams.dedup_stream(stream, ["id"], "ts"), f"{root}/out", f"{root}/ckpt"
        )
        late = streams.late_rows(query)
    out = spark.read.parquet(f"{root}/out").groupBy("id").count().collect()
    assert {r["id"]: r["count"] for r in out} == {1: 2, 2: 1, 3: 1}
    assert late == 1


def test_guard_refuses_half_a_unit(spark, tmp_path):
    target, ckpt = str(tmp_path / "t"), str(tmp_path / "c")
    streams.guard_checkpoint(spark, target, ckpt)
    spark.range(1).write.parquet(target)
    with pytest.raises(streams.CheckpointMismatch):
        streams.guard_checkpoint(spark, target, ckpt)
    spark.range(1).write.parquet(f"{ckpt}/offsets")
    streams.guard_checkpoint(spark, target, ckpt)
    with pytest.raises(streams.CheckpointMismatch):
        streams.guard_checkpoint(spark, str(tmp_path / "other"), ckpt)


def test_a_second_run_reads_nothing(spark, tmp_path):
    root = str(tmp_path)
    spark.range(10).write.parquet(f"{root}/in")
    counts = []
    for _ in range(2):
        stream = T.stream_table(spark, f"{root}/in", "id bigint")
        query = streams.append_stream(stream, f"{root}/out", f"{root}/ckpt")
        counts.append((streams.rows_read(query), streams.observed_counts(query).get("rows", 0)))
    assert counts == [(10, 10), (0, 0)]
    assert spark.read.parquet(f"{root}/out").count() == 10


def test_service_levels_of_closed_hours_equal_the_batch(spark, tmp_path):
    root = str(tmp_path)
    schema = (
        "log_id int, request_id string, user_id int, endpoint string, http_method string, "
        "response_status_code string, execution_time_ms string, timestamp string"
    )

    def row(request, minute, status="200", ms="10"):
        return (minute, request, 1, "/q", "POST", status, ms, str(at(minute)))

    kept = [
        [row("a", 0), row("b", 5, "500", "30"), row("c", 7, ms=None), row("d", 90)],
        [row("e", 50, ms="20")],
        [row("f", 400)],
    ]
    batches = [
        kept[0],
        [*kept[1], row("d", 91), row(None, 59)],  # in time; a repeat, and one that breaks a rule
        kept[2],
        [row("g", 10, "500")],  # its hour is closed
        [row("h", 600)],  # its hour is open
    ]
    late = 0
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/in/part={n}")
        stream = T.stream_table(spark, f"{root}/in/*", schema)
        query = streams.append_stream(streams.api_slo_stream(stream), f"{root}/out", f"{root}/ckpt")
        late += streams.late_rows(query)
    events = shape.silver_request_events(spark.createDataFrame(sum(kept, []), schema))
    batch = marts.api_slo_hourly(events)
    out = spark.read.parquet(f"{root}/out").select(batch.columns)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))
    assert out.count() == 3 and late == 1


def test_a_stream_reads_what_another_stream_wrote(spark, tmp_path):
    root = str(tmp_path)
    for n, columns in enumerate((["id"], ["id", "more"])):
        rows = spark.range(n * 10, n * 10 + 10).withColumn("more", F.col("id") * 2)
        rows.select(columns).write.parquet(f"{root}/in/part={n}")
        first = T.stream_table(spark, f"{root}/in/*", rows.select(columns).schema)
        streams.append_stream(first, f"{root}/mid", f"{root}/ckpt/mid")
        second = T.stream_table(spark, f"{root}/mid", rows.schema)  # wider than the old files
        query = streams.append_stream(second, f"{root}/out", f"{root}/ckpt/out")
        assert streams.observed_counts(query) == {"rows": 10}
    out = T.read_table(spark, f"{root}/out").collect()
    assert {r.id: r.more for r in out} == {i: i * 2 if i >= 10 else None for i in range(20)}


def test_stream_reports_quality(spark, tables, tmp_path):
    root = str(tmp_path)
    log = tables.request_log()
    log.write.parquet(f"{root}/in")
    query = streams.append_stream(
        streams.silver_request_stream(T.stream_table(spark, f"{root}/in", log.schema), "quality"),
        f"{root}/out",
        f"{root}/ckpt",
    )
    seen = streams.observed_counts(query, "quality")
    report = quality.quality_report(
        dedup_batch(shape.silver_request_events(log), ["request_id"], ["log_id"]),
        quality.REQUEST_EVENT_RULES,
    ).collect()
    assert {r["rule"]: r["rows_failed"] for r in report if r["action"] == "drop"} == {
        "has_request_id": seen["has_request_id"]
    }


# --- the whole flow --------------------------------------------------------------------------


def full_log(tables):
    """The query log with the columns a source table has."""
    log = dedup_batch(tables.query_log(), ["q_id"], ["time_stamp"])
    return shape.with_missing_as_null(
        log,
        {
            "user_message": "string",
            "llm_response": "string",
            "allow_budget_override": "boolean",
            "validation_result": "string",
            "tokens_estimated": "int",
            "execution_time_ms": "int",
            "is_successful": "boolean",
        },
    ).withColumn("is_successful", F.col("query_status") == "success").where("q_id > 0")


def full_requests(tables):
    return shape.with_missing_as_null(
        tables.request_log(), {"response_message": "string", "backend_trace": "string"}
    ).where("log_id > 0")


def test_three_lanes_into_gold(spark, tables, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    sources = {"query_log": full_log(tables), "request_log": full_requests(tables)}

    # event files: two exports of part of the log, then the rest; each row arrives once
    total = sources["query_log"].count()
    written = []
    for limit in (700, 700, None):
        for name, source in sources.items():
            lake.export(name, source.cache(), limit)
            counts = lake.ingest_files(name)
            if name == "query_log":
                written.append(counts.get("rows", 0))
        lake.refine_events()
    assert written == [700, 700, total - 1400]
    bronze = spark.read.parquet(lake.path("bronze", "query_log_raw"))
    audit = quality.audit_increment(bronze.limit(0), bronze, sources["query_log"], "q_id").first()
    assert audit["is_exact"]
    # nothing new: the watermark stays and no row is written
    mark = lake.export("query_log", sources["query_log"])
    assert mark == sources["query_log"].agg(F.max("q_id")).first()[0]
    assert lake.ingest_files("query_log").get("rows", 0) == 0

    # gold by touched days equals gold rebuilt
    half = spark.read.parquet(lake.path("silver", "query_log_events"))
    marks = sorted(r[0] for r in half.select("_ingested_at").distinct().collect())
    assert len(marks) >= 3
    lake.build_gold()
    partial = lake.build_gold(since=F.lit(marks[-2]))
    gold = lake.build_gold()
    assert 0 < partial["token_usage_hourly"] < gold["token_usage_hourly"]
    batch = marts.token_usage_hourly(
        quality.expect_or_drop(
            shape.silver_query_events(sources["query_log"]), {"u": "user_id IS NOT NULL"}
        ).withColumn("event_ts", F.date_trunc("second", "event_ts"))
    )
    stored = spark.read.parquet(lake.path("gold", "token_usage_hourly")).select(batch.columns)
    assert gold["token_usage_hourly"] == batch.count() == stored.count()
    assert stored.exceptAll(batch).count() == 0

    # snapshots: a limit is raised, a user leaves
    plans, users = tables.plans(), tables.users()
    raised = plans.withColumn(
        "hourly_token_limit",
        F.when(F.col("plan_id") == 1, 999).otherwise(F.col("hourly_token_limit")),
    )
    for n, (p, u) in enumerate([(plans, users), (raised, users.where("user_id <> 3"))]):
        when = F.lit(at(n * 60))
        assert lake.ingest_snapshot("plans", p, n, when) == 5
        lake.ingest_snapshot("users", u, n, when)
        lake.ingest_snapshot("users_usage", tables.usage(), n, when)
    versions = lake.dimension("plans").history(spark, 1)
    assert versions.count() == 6
    assert [
        (r["hourly_token_limit"], r["__END_AT"])
        for r in versions.where("plan_id = 1").orderBy("__START_AT").collect()
    ] == [(80, at(60)), (999, None)]
    left = lake.dimension("users").history(spark, 1).where("user_id = 3").collect()
    assert [r["__END_AT"] for r in left] == [at(60)]
    assert lake.silver("users_usage").count() == tables.usage().count()

    # change feed: the plan history once more, out of messages
    image = F.struct(*[F.col(c).cast("int").alias(c) if c == "is_active" else F.col(c) for c in plans.columns])
    for n, p in enumerate([plans, raised.where("plan_id = 1")]):
        value = F.to_json(F.struct(image.alias("after"), F.lit("u").alias("op"), F.lit(1000 + n).alias("ts_ms")))
        p.select(
            F.lit("app.plans").alias("topic"),
            F.lit(0).alias("partition"),
            (F.col("plan_id") + 100 * n).cast("bigint").alias("offset"),
            F.lit(at(n)).alias("timestamp"),
            F.lit(None).cast("binary").alias("key"),
            value.cast("binary").alias("value"),
        ).write.parquet(lake.path("broker", f"part={n}"))
        assert lake.ingest_changes("parquet", {}, lake.path("broker", "*"))["rows"] == p.count()
        store = lake.refine_changes("plans", "app.plans")
    log = store.latest(spark)
    assert log.count() == 6
    both = history.compare_lanes(versions, log, ["plan_id", "hourly_token_limit"])
    assert both.where("plan_id = 1").count() == 4


def test_gold_by_touched_days_equals_a_rebuild(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "lake"))

    def silver(rows, ingested):
        cols = "q_id int, user_id int, plan_id int, event_ts timestamp, query_status string, tokens_used int"
        df = spark.createDataFrame(rows, cols).withColumn("_ingested_at", F.lit(ingested))
        df = df.withColumn("event_day", F.to_date("event_ts"))
        df.write.mode("append").partitionBy("event_day").parquet(lake.path("silver", "query_log_events"))
        df.select(
            F.col("q_id").alias("log_id"),
            F.lit("/x").alias("endpoint"),
            F.lit("GET").alias("http_method"),
            F.col("tokens_used").alias("execution_time_ms"),
            F.lit(False).alias("is_error"),
            "event_ts",
            "_ingested_at",
            "event_day",
        ).write.mode("append").partitionBy("event_day").parquet(lake.path("silver", "request_log_events"))

    day = 24 * 60
    silver([(1, 1, 1, at(0), "success", 5), (2, 1, 1, at(day), "failed", 6)], at(2 * day))
    assert lake.build_gold()["token_usage_hourly"] == 2
    silver([(3, 1, 1, at(day + 1), "success", 7)], at(3 * day))
    assert lake.build_gold(since=F.lit(at(2 * day)))["token_usage_hourly"] == 1

    def stored():
        df = spark.read.parquet(lake.path("gold", "token_usage_hourly"))
        return sorted((r["usage_hour"], r["tokens_used"], r["query_count"]) for r in df.collect())

    partial = stored()
    lake.build_gold()
    assert partial == stored() == [(at(0), 5, 1), (at(day), 13, 2)]
