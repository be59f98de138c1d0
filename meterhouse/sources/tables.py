"""Tables in a shared folder: existence, overwrite, batch and stream reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def complete_versions(spark: SparkSession, path: str, column: str) -> list[int]:
    """Numbers of the finished ``column=n`` folders below a path, by listing it."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    numbers = [int(n.split("=")[1]) for n in names if n.startswith(f"{column}=")]
    return sorted(n for n in numbers if path_exists(spark, f"{path}/{column}={n}/_SUCCESS"))


def write_snapshot(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Overwrites a table with its schema; returns the rows written, counted in the same pass."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def write_partitions(df: DataFrame, path: str, partition_by: list[str]) -> int:
    """Replaces the partitions that ``df`` has rows for and leaves the others; returns the rows."""
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return seen.get["rows"]


def append_snapshot(df: DataFrame, path: str, version: str) -> int:
    """Adds one snapshot to a stack of snapshots; writing the same version again replaces it."""
    return write_snapshot(df, f"{path}/snapshot={version}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Batch read; columns added over time are NULL in older files."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = None
) -> DataFrame:
    """Stream over a parquet table: each run reads the files it has not seen."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
