"""The whole flow: three ingestion lanes into bronze, typed silver, reporting gold.

Every step can be run again: pulls move a stored watermark, streams a checkpoint, snapshots and
change batches write numbered folders, gold is rebuilt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterhouse.functions.schemas import (
    PLAN_IMAGE,
    QUERY_LOG_COLUMNS,
    REQUEST_LOG_COLUMNS,
    USER_IMAGE,
    envelope,
    names_of,
)
from meterhouse.operators import marts, shape
from meterhouse.sources import changefeed, files, jdbc, tables
from meterhouse.streaming import events as streams
from meterhouse.streaming.history import ChangeHistory, SnapshotHistory

# Lane labels, and the tables whose changes are kept as history.
FILE_LANE = "volume_autoloader"
SNAPSHOT_META = ["_snapshot_at"]
DIMENSION_KEYS = {"plans": ["plan_id"], "users": ["user_id"]}
IMAGES = {"plans": PLAN_IMAGE, "users": USER_IMAGE}


def as_landed(columns: str) -> str:
    """A declared schema as event files hold it: times as text, booleans as 0/1."""
    types = {"timestamp": "string", "boolean": "int"}
    pairs = [part.split() for part in columns.split(", ")]
    return ", ".join(f"{name} {types.get(kind, kind)}" for name, kind in pairs)


LANDED = {
    "query_log": as_landed(QUERY_LOG_COLUMNS),
    "request_log": as_landed(REQUEST_LOG_COLUMNS),
}


class Lakehouse:
    """Bronze, silver and gold tables below one shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    # --- snapshots ---------------------------------------------------------------------------

    def ingest_snapshot(self, name: str, df: DataFrame, n: int, at: Column) -> int:
        """Snapshot ``n`` of a table: bronze, then its silver history or, for counters, its state."""
        bronze = self.path("bronze", f"snap_{name}")
        rows = tables.write_snapshot(jdbc.stamp_snapshot(df, at), bronze)
        snap = self.spark.read.parquet(bronze)
        if name in DIMENSION_KEYS:
            self.dimension(name).apply(snap, at, n)
        else:
            tables.write_snapshot(snap.drop(*SNAPSHOT_META), self.path("silver", name))
        return rows

    def dimension(self, name: str) -> SnapshotHistory:
        keys = DIMENSION_KEYS[name]
        return SnapshotHistory(self.path("silver", name), keys, track_except=SNAPSHOT_META)

    # --- event files -------------------------------------------------------------------------

    def export(self, name: str, source: DataFrame, limit: int | None = jdbc.PULL_LIMIT) -> int:
        """Lands the rows after the stored watermark; saves it per table, once they have landed."""
        key = jdbc.APPEND_TABLES[name]
        state = self.path("state", name)
        mark = jdbc.load_watermarks(self.spark, state, {name: key})[name]
        rows, new = jdbc.pull_increment(source, key, mark, limit)
        if new > mark:
            files.land_ndjson(rows, self.path("landing"), name, key)
            jdbc.save_watermarks(self.spark, state, {name: new})
        return new

    def ingest_files(self, name: str) -> dict[str, int]:
        """Streams landed files into bronze; returns what this run wrote."""
        lines = files.stream_ndjson(self.spark, self.path("landing", name), LANDED[name])
        query = streams.append_stream(
            shape.with_provenance(lines, FILE_LANE),
            self.path("bronze", f"{name}_raw"),
            self.path("_ckpt", f"{name}_raw"),
        )
        return streams.observed_counts(query)

    def refine_events(self) -> None:
        """Bronze to silver for both event tables, partitioned by the day of the event."""
        for name, make in (
            ("query_log", streams.silver_query_stream),
            ("request_log", streams.silver_request_stream),
        ):
            bronze = self.path("bronze", f"{name}_raw")
            schema = self.spark.read.parquet(bronze).schema
            rows = make(tables.stream_table(self.spark, bronze, schema), f"{name}_quality")
            streams.append_stream(
                rows.withColumn("event_day", F.to_date("event_ts")),
                self.path("silver", f"{name}_events"),
                self.path("_ckpt", f"{name}_events"),
                partition_by=["event_day"],
            )

    # --- change feed -------------------------------------------------------------------------

    def ingest_changes(self, fmt: str, opts: dict[str, str], path: str | None = None) -> dict[str, int]:
        """Appends change messages to one raw table, partitioned by topic, payloads unparsed."""
        query = streams.append_stream(
            shape.cdc_bronze(changefeed.read_cdc_stream(self.spark, fmt, opts, path)),
            self.path("bronze", "cdc_raw"),
            self.path("_ckpt", "cdc_raw"),
            partition_by=["topic"],
        )
        return streams.observed_counts(query)

    def refine_changes(self, name: str, topic: str) -> ChangeHistory:
        """History of one table out of its topic; other topics are pruned by partition."""
        bronze = self.path("bronze", "cdc_raw")
        schema = self.spark.read.parquet(bronze).schema
        rows = shape.flatten_changes(
            tables.stream_table(self.spark, bronze, schema),
            topic,
            envelope(IMAGES[name]),
            names_of(IMAGES[name]),
        )
        store = ChangeHistory(self.path("silver", f"{name}_cdc"), DIMENSION_KEYS[name])
        store.run(rows, self.path("_ckpt", f"{name}_cdc"))
        return store

    # --- gold --------------------------------------------------------------------------------

    def silver(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path("silver", name))

    def touched_days(self, name: str, since: Column) -> Column:
        """Condition on ``event_day`` for the days that received rows after ``since``."""
        new = self.silver(name).where(F.col("_ingested_at") > since)
        # one value per day
        days = [r[0] for r in new.select("event_day").distinct().collect()]
        known = F.col("event_day").isin([d for d in days if d is not None])
        return known | F.col("event_day").isNull() if None in days else known

    def build_gold(self, mode: str = "reference", since: Column | None = None) -> dict[str, int]:
        """Rebuilds the two hourly marts from silver; returns the rows written.

        With ``since``, only days with rows ingested after it are read and replaced; an hour never
        spans two days, so those days come out as a full rebuild would leave them.
        """
        written = {}
        for name, source, aggregate in (
            ("token_usage_hourly", "query_log_events", lambda df: marts.token_usage_hourly(df, mode)),
            ("api_slo", "request_log_events", marts.api_slo_hourly),
        ):
            rows = self.silver(source)
            if since is not None:
                rows = rows.where(self.touched_days(source, since))
            mart = aggregate(rows).withColumn("usage_day", F.to_date("usage_hour"))
            write = tables.write_snapshot if since is None else tables.write_partitions
            written[name] = write(mart, self.path("gold", name), ["usage_day"])
        return written
