"""The quota gate over a stream of requests, with each user's counters kept between batches.

``meter_stream`` keeps them as keyed state and answers at once; a user's share of a micro-batch passes
through one task whole, so the source has to be rate-limited. ``MeterStore`` keeps them in a table and
takes micro-batches of any size, a backlog with most of its rows on one user among them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from meterhouse.operators.replay import (
    DECIDED,
    LIMITS,
    LINE_SCHEMA,
    PASSED_ON,
    START,
    STATE,
    Meter,
    compact,
    new_meter,
    outcomes_of,
    replay_lines,
)
from meterhouse.sources.tables import complete_versions
from meterhouse.streaming.events import guard_checkpoint, run_available_now

STATE_SCHEMA = ", ".join(f"{c} bigint" for c in STATE)


class UserMeter(StatefulProcessor):
    """Holds seven numbers per user; the requests of a batch run in event order."""

    def __init__(self, mode: str):
        self.forget = mode == "api"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counters = handle.getValueState("counters", STATE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        # one user's share of a rate-limited micro-batch
        pdf = pd.concat(list(rows)).sort_values(["ts_us", "request_seq"], kind="stable")
        head = pdf.iloc[0]
        limits = [int(v) for v in head[LIMITS]]
        if self.counters.exists():
            meter = Meter([int(v) for v in self.counters.get()], limits)
        else:
            start = [None if pd.isna(v) else int(v) for v in head[START]]
            meter = new_meter(int(head["ts_us"]), start, limits)
        times, amounts, allows = (pdf[c].tolist() for c in ("ts_us", "tokens", "allow_budget"))
        decided = pd.DataFrame(meter.run(times, amounts, allows, self.forget), columns=DECIDED)
        self.counters.update(meter.state)
        yield pd.concat([pdf[PASSED_ON].reset_index(drop=True), decided], axis=1)

    def close(self) -> None:
        pass


def meter_stream(requests: DataFrame, limits: DataFrame, mode: str = "procedure") -> DataFrame:
    """Outcome of every request of a stream; ``limits`` comes from ``replay.user_limits``.

    Equals ``replay_gate`` as long as each batch holds later requests than the ones before it.
    """
    return (
        compact(requests)
        .join(limits, "user_id")
        .groupBy("user_id")
        .transformWithStateInPandas(
            UserMeter(mode), outputStructType=LINE_SCHEMA, outputMode="Append", timeMode="None"
        )
        .withColumn("ts", F.timestamp_micros("ts_us"))
        .withColumn("outcome", F.coalesce("record_msg", "validate_msg"))
        .drop("ts_us", "hourly_start", "daily_start", "monthly_start")
    )


BUCKETS = 256
BUCKET, BATCH, VERSION = "_bucket", "_batch", "_version"
COUNTERS_SCHEMA = f"user_id int, {STATE_SCHEMA}, {BUCKET} int, {VERSION} int"


class MeterStore:
    """Outcomes and counters of the gate, batch by batch, in numbered folders.

    Batch ``n`` replays its requests from the newest counters with the batch replay, which cuts users with
    many requests into pieces, and writes ``outcomes/_batch=n``. Users fall into ``buckets`` buckets by hash;
    ``counters/_version=n`` has those that the batch touches, whole, so its cost follows what it touches. A
    replayed batch writes the same folders again, and a batch whose predecessors are not all there is
    refused. The outcomes equal those of one replay as long as each batch holds later requests than the
    ones before it. ``limits`` comes from ``replay.user_limits``; a user's counters and budget, once stored,
    go on from there. ``options`` are those of ``replay.replay_lines``.
    """

    def __init__(
        self, root: str, limits: DataFrame, mode: str = "procedure", buckets: int = BUCKETS, **options
    ):
        self.root = root.rstrip("/")
        self.limits = limits
        self.mode = mode
        self.buckets = buckets
        self.options = options

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("user_id"), F.lit(self.buckets)).cast("int")

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        missing = sorted(set(range(batch_id)) - set(self._done(spark)))
        if missing:
            raise RuntimeError(f"batch {batch_id} of {self.root} lacks versions {missing[:5]}")
        # a written table: the replay reads it several times
        path = f"{self.root}/requests/{BATCH}={batch_id}"
        compact(batch).withColumn(BUCKET, self._bucket()).write.mode("overwrite").parquet(path)
        rows = spark.read.parquet(path)
        # at most ``buckets`` numbers
        touched = [r[0] for r in rows.select(BUCKET).distinct().collect() if r[0] is not None]
        before = self._counters(spark, batch_id - 1).where(F.col(BUCKET).isin(touched))
        kept = before.select("user_id", *[F.col(c).alias(f"_{c}") for c in STATE])
        start = [F.coalesce(f"_{c}", name).alias(name) for c, name in zip(STATE, START)]
        state = self.limits.where(self._bucket().isin(touched)).join(kept, "user_id", "left")
        state = state.select("user_id", *LIMITS, *start)
        lines = replay_lines(rows.drop(BUCKET), state, self.mode, **self.options)
        outcomes = f"{self.root}/outcomes/{BATCH}={batch_id}"
        lines.write.mode("overwrite").parquet(outcomes)
        newest = (
            spark.read.schema(LINE_SCHEMA)
            .parquet(outcomes)
            .groupBy("user_id")
            .agg(F.max_by(F.struct(*STATE), F.struct("ts_us", "request_seq")).alias("_s"))
            .select("user_id", "_s.*")
        )
        others = before.join(newest.select("user_id"), "user_id", "left_anti")
        after = newest.unionByName(others.select(*newest.columns)).withColumn(BUCKET, self._bucket())
        # one file for each bucket
        after.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(
            f"{self.root}/counters/{VERSION}={batch_id}"
        )

    def _done(self, spark: SparkSession) -> list[int]:
        return complete_versions(spark, f"{self.root}/counters", VERSION)

    def _counters(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Every user's newest counters after a batch: of each bucket its last version up to there."""
        if batch_id < 0:
            return spark.createDataFrame([], COUNTERS_SCHEMA)
        written = spark.read.schema(COUNTERS_SCHEMA).parquet(f"{self.root}/counters")
        written = written.where(F.col(VERSION) <= batch_id)
        last = written.groupBy(BUCKET).agg(F.max(VERSION).alias(VERSION))  # at most ``buckets`` rows
        return written.join(F.broadcast(last), [BUCKET, VERSION], "left_semi")

    def run(self, requests: DataFrame, checkpoint: str) -> StreamingQuery:
        """Meters all available requests, then stops; refuses a store without its checkpoint."""
        guard_checkpoint(requests.sparkSession, f"{self.root}/counters", checkpoint)
        query = (
            requests.writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        return run_available_now(query)

    def counters(self, spark: SparkSession) -> DataFrame:
        """Counters and budget of each user after the last batch that was written to its end."""
        return self._counters(spark, max(self._done(spark), default=-1)).drop(BUCKET, VERSION)

    def outcomes(self, spark: SparkSession) -> DataFrame:
        """Outcomes of all batches that were written to their end."""
        done = max(self._done(spark), default=-1)
        if done < 0:
            return outcomes_of(spark.createDataFrame([], LINE_SCHEMA))
        lines = spark.read.schema(f"{LINE_SCHEMA}, {BATCH} int").parquet(f"{self.root}/outcomes")
        return outcomes_of(lines.where(F.col(BATCH) <= done))
