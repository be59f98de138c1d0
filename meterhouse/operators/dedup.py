"""Batch deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_batch(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key along ``order``, over the whole history.

    Spark cuts each key to its first row inside the map tasks (WindowGroupLimit), so many copies of
    one key never meet in one task. Rows with a NULL key form one group, as in the stream.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
