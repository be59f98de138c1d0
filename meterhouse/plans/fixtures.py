"""Metering tables derived from the driver's tables: the same rows as ``oracles.VIEWS``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Schemas by path, as a catalog would keep them: footers are read once per session, not per query.
_SCHEMAS: dict[str, T.StructType] = {}


class Tables:
    """Reads one folder of driver tables and shapes them as metering tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def plans(self) -> DataFrame:
        key = F.col("r_regionkey")
        return self.raw("region").select(
            key.alias("plan_id"),
            F.col("r_name").alias("plan_name"),
            (60 + 20 * key).alias("hourly_token_limit"),
            (150 + 50 * key).alias("daily_token_limit"),
            (1500 + 500 * key).alias("monthly_token_limit"),
            (key != 4).alias("is_active"),
        )

    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        budget = (200 + 100 * (key % 5)).cast("int")
        return (
            self.raw("customer")
            .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                key.cast("int").alias("user_id"),
                F.col("c_name").alias("user_name"),
                F.col("n_regionkey").alias("plan_id"),
                budget.alias("token_budget"),
                budget.alias("remaining_budget"),
                (key % 10 != 9).alias("is_active"),
            )
        )

    def plan_versions(self) -> DataFrame:
        """Snapshots of the plans at the four times a limit changed; plan 3 joins at the second."""
        starts = F.array(
            *[
                F.lit(t).cast("timestamp")
                for t in (
                    "2024-01-01 00:00:00",
                    "2024-01-08 00:00:00",
                    "2024-01-15 12:00:00",
                    "2024-01-22 00:00:00",
                )
            ]
        )
        return (
            self.plans()
            .select("*", F.posexplode(starts).alias("version", "start_at"))
            .where((F.col("plan_id") != 3) | (F.col("version") != 0))
            .withColumn(
                "hourly_token_limit", F.col("hourly_token_limit") + 10 * F.col("version")
            )
            .select(
                "plan_id",
                "plan_name",
                "hourly_token_limit",
                "daily_token_limit",
                "monthly_token_limit",
                "is_active",
                "start_at",
            )
        )

    def events(self) -> DataFrame:
        """Events with typed columns; the time is an instant, as streams need it."""
        return self.raw("events").select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("user_id").cast("int").alias("user_id"),
            "event_type",
            F.floor("value").cast("int").alias("tokens"),
            "value",
            "props",
        )

    def gate_requests(self) -> DataFrame:
        return self.events().select(
            F.col("event_id").alias("request_seq"),
            "user_id",
            "ts",
            "tokens",
            (F.col("event_id") % 2 == 0).alias("allow_budget"),
        )

    def query_log(self) -> DataFrame:
        """Every successful query is logged twice, bare and full; some full rows repeat."""
        e = self.events().join(self.users().select("user_id", "plan_id"), "user_id")
        status = F.when(F.col("event_type") == "error", "failed").otherwise("success")
        clean = (F.col("event_id") % 101 != 0) & (F.col("event_id") % 89 != 0)
        copies = F.when((F.col("event_id") % 50 == 1) & clean, 2).otherwise(1)
        bare = e.where(F.col("event_type") != "error").select(
            (2 * F.col("event_id")).alias("q_id"),
            "user_id",
            "plan_id",
            F.col("ts").alias("time_stamp"),
            F.lit("success").alias("query_status"),
            F.col("tokens").alias("tokens_used"),
            F.lit(None).cast("string").alias("conversation_id"),
            F.lit("llm_query").alias("message_type"),
        )
        full = e.select(
            (2 * F.col("event_id") + 1).alias("q_id"),
            F.when(F.col("event_id") % 101 != 0, F.col("user_id")).alias("user_id"),
            "plan_id",
            F.col("ts").alias("time_stamp"),
            status.alias("query_status"),
            F.when(F.col("event_id") % 89 != 0, F.col("tokens")).alias("tokens_used"),
            F.concat(F.lit("c"), F.col("event_id")).alias("conversation_id"),
            F.lit("llm_query").alias("message_type"),
            F.explode(F.sequence(F.lit(1), copies)).alias("_copy"),
        ).drop("_copy")
        return bare.unionByName(full)

    def request_log(self) -> DataFrame:
        e = self.events()
        eid = F.col("event_id")
        return e.select(
            eid.alias("log_id"),
            F.when(eid % 103 != 0, F.concat(F.lit("r"), eid)).alias("request_id"),
            "user_id",
            F.when(F.col("event_type").isin("purchase", "signup"), "POST")
            .otherwise("GET")
            .alias("http_method"),
            F.concat(F.lit("/"), F.col("event_type")).alias("endpoint"),
            F.col("props").alias("request_params"),
            F.when(F.col("event_type") != "error", 200)
            .when(eid % 3 == 0, 500)
            .otherwise(400)
            .alias("response_status_code"),
            F.when(eid % 97 != 0, F.floor(F.col("value") * 1000).cast("int")).alias(
                "execution_time_ms"
            ),
            F.concat(F.lit("10.0.0."), eid % 250).alias("client_ip"),
            F.col("ts").alias("timestamp"),
        )

    def traces(self) -> DataFrame:
        level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
        head = (
            '[{"timestamp":"2024-01-01T00:00:00","level":"INFO","message":"START"},'
            '{"timestamp":"2024-01-01T00:00:01","level":"'
        )
        return self.raw("events").select(
            F.col("event_id").alias("request_id"),
            F.concat(F.lit(head), level, F.lit('","message":"END"}]')).alias("backend_trace"),
        )

    def usage(self) -> DataFrame:
        """Counters as of the last events: the final half day, three days and everything."""
        ts = F.col("ts")
        day, half = F.lit("2024-01-27").cast("timestamp"), F.lit("2024-01-29").cast("timestamp")

        def tokens(when):
            return F.coalesce(F.sum(F.when(when, F.col("tokens"))), F.lit(0)).cast("int")

        def start(when):
            return F.coalesce(F.min(F.when(when, ts)), F.max(ts))

        everything = F.lit(True)
        return self.events().groupBy("user_id").agg(
            tokens(ts >= half).alias("hourly_token"),
            start(ts >= half).alias("hourly_session_start"),
            tokens(ts >= day).alias("daily_token"),
            start(ts >= day).alias("daily_session_start"),
            tokens(everything).alias("monthly_token"),
            start(everything).alias("monthly_session_start"),
        )

    def user_changes(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.raw("orders").select(
            F.lit("users").alias("topic"),
            F.lit(0).alias("part"),
            key.alias("offset_"),
            F.col("o_custkey").cast("int").alias("user_id"),
            (key % 5).cast("int").alias("plan_id"),
            F.floor("o_totalprice").cast("int").alias("remaining_budget"),
            F.when((F.col("o_orderstatus") == "P") & (key % 10 == 0), "d")
            .otherwise("u")
            .alias("op"),
            F.col("o_orderdate").cast("timestamp").alias("changed_at"),
        )

    def change_messages(self) -> DataFrame:
        """``user_changes`` as log messages: six source columns and a JSON envelope."""
        image = F.struct("user_id", "plan_id", "remaining_budget")
        gone = F.col("op") == "d"
        envelope = F.to_json(
            F.struct(
                F.when(gone, image).alias("before"),
                F.when(~gone, image).alias("after"),
                "op",
                F.unix_millis("changed_at").alias("ts_ms"),
            )
        )
        return self.user_changes().select(
            F.lit("meter.users").alias("topic"),
            F.col("part").alias("partition"),
            F.col("offset_").alias("offset"),
            F.col("changed_at").alias("timestamp"),
            F.to_json(F.struct("user_id")).cast("binary").alias("key"),
            envelope.cast("binary").alias("value"),
        )

    def user_snapshots(self) -> DataFrame:
        """The last order status of each customer in each year: snapshots with gaps."""
        o = self.raw("orders")
        return (
            o.groupBy(
                F.year("o_orderdate").alias("snap_year"),
                F.col("o_custkey").cast("int").alias("user_id"),
            )
            .agg(
                F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("status"),
            )
        )
