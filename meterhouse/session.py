"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent
CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CONF = "spark.sql.shuffle.partitions"
DEFAULT_SHUFFLE_PARTITIONS = "200"

# Session settings every job relies on; none of them depends on the machine.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Settings that only a new session can take.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "meterhouse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` keys use ``__`` for dots.

    Python processes that the driver starts, local tasks and stateful streams among them, find the
    package from any working folder; executors elsewhere need it installed, or ``ship_package``.
    """
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if str(PACKAGE.parent) not in known:
        os.environ["PYTHONPATH"] = os.pathsep.join([str(PACKAGE.parent), *filter(None, known)])
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**STATIC_CONF, **SESSION_CONF}
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime defaults on a session that somebody else created.

    The number of shuffle partitions belongs to the cluster. Only a local session that left it at
    Spark's default gets one partition per thread, since every partition of a stateful stream opens
    a state store of its own.
    """
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    if _is_local(spark) and spark.conf.get(SHUFFLE_CONF) == DEFAULT_SHUFFLE_PARTITIONS:
        spark.conf.set(SHUFFLE_CONF, str(spark.sparkContext.defaultParallelism))
    return spark


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, for clusters on which it is not installed.

    Needed once for a session, before the first operator that runs Python in tasks.
    """
    target = Path(tempfile.mkdtemp(prefix="meterhouse-ship-")) / "meterhouse.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(PACKAGE.rglob("*.py")):
            archive.write(source, source.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(target))


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def work_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster, set by us only where it is unset and local."""
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="meterhouse-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is ever deleted from it here."""
    return f"{work_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def write_and_read(df, purpose: str, partition_by: list[str] | None = None):
    """Cut the lineage of ``df`` with a written table, so a lost executor costs one stage only."""
    path = work_folder(df.sparkSession, purpose)
    df.write.partitionBy(*partition_by or []).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
