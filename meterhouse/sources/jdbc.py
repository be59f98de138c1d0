"""Relational sources: whole snapshots and increments by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The small mutable tables that are read whole, and the append-only ones by key.
SNAPSHOT_TABLES = ["plans", "users", "users_usage"]
APPEND_TABLES = {"query_log": "q_id", "request_log": "log_id"}
PULL_LIMIT = 10_000


def stamp_snapshot(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Marks every row with the time of the snapshot it belongs to."""
    return df.withColumn("_snapshot_at", F.current_timestamp() if at is None else at)


def jdbc_options(
    url: str, table: str, key: str | None, bounds: tuple[int, int] | None, num_partitions: int
) -> dict[str, str]:
    """Reader options; with a key and its bounds the read is split into parallel range queries."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000"}
    if key and bounds and bounds[0] is not None:
        options.update(
            partitionColumn=key,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1] + 1),
            numPartitions=str(num_partitions),
        )
    return options


def read_jdbc_snapshot(
    spark: SparkSession,
    opts: dict[str, str],
    table: str,
    key: str | None = None,
    num_partitions: int = 16,
    at: Column | None = None,
) -> DataFrame:
    """A whole table over JDBC, read by ``num_partitions`` tasks where it has an integer key."""
    extra = {k: v for k, v in opts.items() if k != "url"}
    bounds = None
    if key:
        limits = f"(select min({key}) as lo, max({key}) as hi from {table}) b"
        row = (
            spark.read.format("jdbc").options(**extra, url=opts["url"], dbtable=limits).load().first()
        )
        bounds = (row[0], row[1])
    options = jdbc_options(opts["url"], table, key, bounds, num_partitions)
    return stamp_snapshot(spark.read.format("jdbc").options(**{**extra, **options}).load(), at)


def increment_query(table: str, key: str, watermark: int, limit: int, overlap: int = 0) -> str:
    """The statement a source runs for one increment."""
    return f"select * from {table} where {key} > {watermark - overlap} order by {key} limit {limit}"


def read_jdbc_increment(
    spark: SparkSession,
    opts: dict[str, str],
    table: str,
    key: str,
    watermark: int,
    limit: int = PULL_LIMIT,
    overlap: int = 0,
) -> DataFrame:
    """One increment over JDBC; the source filters, sorts and cuts, so only new rows travel."""
    query = increment_query(table, key, watermark, limit, overlap)
    return spark.read.format("jdbc").options(**opts, query=query).load()


def pull_increment(
    df: DataFrame, key: str, watermark: int, limit: int | None = PULL_LIMIT, overlap: int = 0
) -> tuple[DataFrame, int]:
    """The next ``limit`` rows after the watermark by key, and the watermark after them.

    ``overlap`` looks back over keys that may have been committed late; readers then dedup by key.
    The watermark stays where it is when nothing is new.
    """
    rows = df.where(F.col(key) > watermark - overlap)
    if limit is not None:
        rows = rows.orderBy(key).limit(limit)
    last = rows.agg(F.max(key)).first()[0]
    return rows, watermark if last is None else max(watermark, int(last))


def load_watermarks(spark: SparkSession, path: str, tables: dict[str, str]) -> dict[str, int]:
    """Stored watermark of each table, 0 for a table or path that has none."""
    from meterhouse.sources.tables import path_exists

    marks = {t: 0 for t in tables}
    if path_exists(spark, path):
        rows = spark.read.schema("table string, watermark bigint").json(path).collect()
        marks.update({r["table"]: r["watermark"] for r in rows if r["table"] in marks})
    return marks


def save_watermarks(spark: SparkSession, path: str, marks: dict[str, int]) -> None:
    rows = [(t, int(w)) for t, w in marks.items()]
    df = spark.createDataFrame(rows, "table string, watermark bigint")
    df.coalesce(1).write.mode("overwrite").json(path)
