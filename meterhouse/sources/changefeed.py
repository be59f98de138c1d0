"""Change messages from a log broker, or from a table with the same six columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MESSAGE_SCHEMA = (
    "topic string, partition int, offset bigint, timestamp timestamp, key binary, value binary"
)

# Read position and rate of the change feed.
STARTING_OFFSETS = "earliest"
MAX_OFFSETS_PER_TRIGGER = 50_000


def kafka_options(
    servers: str,
    pattern: str,
    user: str | None = None,
    password: str | None = None,
    max_offsets: int = MAX_OFFSETS_PER_TRIGGER,
    login_module: str = "org.apache.kafka.common.security.plain.PlainLoginModule",
) -> dict[str, str]:
    """Source options for all topics that match ``pattern``; with a user, over SASL/PLAIN and TLS."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribePattern": pattern,
        "startingOffsets": STARTING_OFFSETS,
        "maxOffsetsPerTrigger": str(max_offsets),
    }
    if user is not None:
        options["kafka.security.protocol"] = "SASL_SSL"
        options["kafka.sasl.mechanism"] = "PLAIN"
        options["kafka.sasl.jaas.config"] = (
            f'{login_module} required username="{user}" password="{password}";'
        )
    return options


def read_cdc_stream(
    spark: SparkSession, fmt: str, opts: dict[str, str], path: str | None = None
) -> DataFrame:
    """Stream of change messages: ``kafka``, or a file format over stored messages."""
    reader = spark.readStream.format(fmt).options(**opts)
    if fmt == "kafka":
        return reader.load()
    return reader.schema(MESSAGE_SCHEMA).load(path)


def read_cdc_batch(
    spark: SparkSession, fmt: str, opts: dict[str, str], path: str | None = None
) -> DataFrame:
    """The same messages in one batch, from the earliest to the latest."""
    batch = {k: v for k, v in opts.items() if k not in ("maxOffsetsPerTrigger", "maxFilesPerTrigger")}
    reader = spark.read.format(fmt).options(**batch)
    if fmt == "kafka":
        return reader.load()
    return reader.schema(MESSAGE_SCHEMA).load(path)
