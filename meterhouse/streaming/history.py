"""History kept up to date by a stream of changes or by one snapshot after another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from meterhouse.operators.history import scd2_apply_snapshot, scd2_from_changes
from meterhouse.sources.tables import complete_versions
from meterhouse.streaming.events import guard_checkpoint, run_available_now


def _with_numbers(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(n, T.IntegerType()) for n in names]])


BUCKETS = 256
BUCKET, BATCH, VERSION = "_bucket", "_batch", "_version"


class ChangeHistory:
    """SCD2 of a change stream, exact for late and out-of-order changes.

    Keys fall into ``buckets`` buckets by hash. Batch ``n`` adds its changes to ``changes/_batch=n`` and
    writes ``history/_version=n`` for the buckets it touches only, from all changes of these; the newest version
    of every bucket is the history. So the cost of a batch follows the buckets that it touches, and other
    buckets are neither read nor copied. A replayed batch writes the same two folders again, so a lost run
    does no harm. A batch whose predecessors are not all there is refused.
    """

    def __init__(self, root: str, keys: list[str], buckets: int = BUCKETS, **options):
        self.root = root.rstrip("/")
        self.keys = keys
        self.buckets = buckets
        self.options = options

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self._check_before(spark, batch_id)
        changes = f"{self.root}/changes/{BATCH}={batch_id}"
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        bucketed = batch.withColumn(BUCKET, bucket)
        bucketed.write.mode("overwrite").partitionBy(BUCKET).parquet(changes)
        schema = bucketed.schema
        touched = [
            r[0] for r in spark.read.schema(schema).parquet(changes).select(BUCKET).distinct().collect()
        ]  # at most ``buckets`` numbers
        stored = (
            spark.read.schema(_with_numbers(schema, BATCH))
            .parquet(f"{self.root}/changes")
            .where((F.col(BATCH) <= batch_id) & F.col(BUCKET).isin(touched))
        )
        fresh = scd2_from_changes(stored.drop(BATCH, BUCKET), self.keys, **self.options)
        fresh.limit(0).write.mode("overwrite").parquet(f"{self.root}/schema")
        fresh.withColumn(BUCKET, bucket).write.mode("overwrite").partitionBy(BUCKET).parquet(
            f"{self.root}/history/{VERSION}={batch_id}"
        )

    def _check_before(self, spark: SparkSession, batch_id: int) -> None:
        done = complete_versions(spark, f"{self.root}/history", VERSION)
        missing = sorted(set(range(batch_id)) - set(done))
        if missing:
            raise RuntimeError(f"batch {batch_id} of {self.root} lacks versions {missing[:5]}")

    def run(self, changes: DataFrame, checkpoint: str) -> StreamingQuery:
        """Applies all available changes, then stops; refuses a store without its checkpoint."""
        guard_checkpoint(changes.sparkSession, f"{self.root}/history", checkpoint)
        query = (
            changes.writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        return run_available_now(query)

    def latest(self, spark: SparkSession) -> DataFrame:
        """The history after the last batch that was written to its end."""
        newest = complete_versions(spark, f"{self.root}/history", VERSION)[-1]
        schema = spark.read.parquet(f"{self.root}/schema").schema
        written = spark.read.schema(_with_numbers(schema, BUCKET, VERSION)).parquet(
            f"{self.root}/history"
        )
        touched = spark.read.schema(f"{BATCH} int, {BUCKET} int").parquet(f"{self.root}/changes")
        last = touched.where(F.col(BATCH) <= newest).groupBy(BUCKET)
        last = last.agg(F.max(BATCH).alias(VERSION))  # at most ``buckets`` rows
        return written.join(F.broadcast(last), [BUCKET, VERSION], "left_semi").drop(BUCKET, VERSION)


class SnapshotHistory:
    """SCD2 of a dimension that arrives as whole snapshots.

    Open versions are rewritten by each snapshot (``open/v=n``), closed ones only ever added
    (``closed/v=n``). Applying snapshot ``n`` again writes the same two folders again.
    """

    def __init__(self, root: str, keys: list[str], tracked=None, track_except=None):
        self.root = root.rstrip("/")
        self.keys = keys
        self.tracked = tracked
        self.track_except = track_except or []

    def apply(self, snap: DataFrame, at: Column, n: int) -> None:
        spark = snap.sparkSession
        before = f"{self.root}/open/v={n - 1}"
        if n > 0:
            current = spark.read.parquet(before)  # a missing one is an error, not a fresh start
        else:
            current = snap.limit(0).select(
                "*", at.alias("__START_AT"), F.lit(None).cast("timestamp").alias("__END_AT")
            )
        opened, closed = scd2_apply_snapshot(
            current, snap, self.keys, at, self.tracked, self.track_except
        )
        opened.write.mode("overwrite").parquet(f"{self.root}/open/v={n}")
        closed.write.mode("overwrite").parquet(f"{self.root}/closed/v={n}")

    def history(self, spark: SparkSession, n: int) -> DataFrame:
        """All versions after snapshot ``n``."""
        opened = spark.read.parquet(f"{self.root}/open/v={n}")
        closed = spark.read.schema(opened.schema).parquet(
            *[f"{self.root}/closed/v={i}" for i in range(n + 1)]
        )
        return opened.unionByName(closed)
