"""The corpus tables as the numbered operators read them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id and whole text of every document; a null text is an empty one."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def fresh(df: DataFrame, purpose: str) -> str:
    """A column name that no column of ``df`` has, in any letter case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{purpose}"
    while name.lower() in taken:
        name = f"_{purpose}_{uuid.uuid4().hex[:6]}"
    return name


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds
