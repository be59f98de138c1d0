"""Corpus pipeline: good documents, one of each group of near copies, without benchmark items and
secrets, as tokens.

Every stage takes the rows that its predecessor kept and returns them with the columns of documents; the
last returns doc_id, n_tokens and ids. Between stages the rows are a written table in the shared folder,
so a lost executor costs the stage that runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterhouse.llm import bpe, decontaminate, quality, secrets, simhash
from meterhouse.session import write_and_read

RANKS = "byte_bpe_50k.tiktoken"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier takes for good."""
    return quality.only_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each component: four words, four bits, as the operator has them."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced and the length brought up to date."""
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as ids."""
    import public_tokenizers

    ranks = bpe.load_ranks(public_tokenizers.path(RANKS))
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", good_documents),
    ("near_dedup", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("tokens", tokens),
]

ORACLE_SQL = None  # no stage but the decontamination can be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_and_read(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
