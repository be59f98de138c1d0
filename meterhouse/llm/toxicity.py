"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A feature is an n-gram of lower-cased characters that a text holds, hashed; its value is the log ratio
of the n-gram's smoothed frequencies among toxic and other texts. N-grams met in fewer than
``LEAST_TEXTS`` texts, or whose ratio says little, are left out. A logistic regression weighs the
features. It is fitted on at most ``SAMPLE`` labelled texts; whole texts are scored, row by row, so
scoring shuffles nothing.

A null or empty text has no features and gets the score of the intercept. Null ids count as not held
out. Repeated rows are scored alike, further columns of ``docs`` pass through ``score``. Without
labels the score is 0.5, and with labels of one kind it is their smoothed share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhouse.llm.tables import documents, fold_of
from meterhouse.llm.training import fit_sparse, labelled, sigmoid

SAMPLE = 8_000
ORDERS = (3, 4, 5)
HASH_BITS = 20
LEAST_TEXTS = 5
LEAST_RATIO = 1.5
CHUNK = 1_000_000
FOLDS, HELD_OUT, CUTOFF = 4, 2, 0.3
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def ngrams(text: str) -> Iterator[np.ndarray]:
    """Hashes of all character n-grams, some at a time; a blank stands at either end."""
    chars = f" {text.lower()} "
    for at in range(0, len(chars), CHUNK):
        part = chars[at : at + CHUNK + ORDERS[-1] - 1].encode("utf-32-le", "replace")
        codes = np.frombuffer(part, np.uint32).astype(np.uint64)
        run = np.zeros(len(codes), np.uint64)
        for n in range(1, min(ORDERS[-1], len(codes)) + 1):
            size = len(codes) - n + 1
            run = (run[:size] + codes[n - 1 :] + np.uint64(1)) * FACTOR
            if n in ORDERS:
                yield ((run * FACTOR) >> np.uint64(64 - HASH_BITS)).astype(np.uint32)


class Model:
    def __init__(self, rows: list[tuple[str, int]]):
        size = 1 << HASH_BITS
        y = np.array([label for _, label in rows], float)
        held = [
            np.unique(np.concatenate([np.zeros(0, np.uint32), *ngrams(text)])) for text, _ in rows
        ]
        counts = [np.zeros(size, np.int64), np.zeros(size, np.int64)]
        for found, label in zip(held, y.astype(int)):
            counts[label][found] += 1
        other, toxic = counts
        ratio = np.log((toxic + 1) / (y.sum() + 2)) - np.log((other + 1) / (len(y) - y.sum() + 2))
        kept = (toxic + other >= LEAST_TEXTS) & (np.abs(ratio) >= LEAST_RATIO)
        feature = np.cumsum(kept) - 1
        columns = [feature[found[kept[found]]] for found in held]
        row = np.repeat(np.arange(len(rows)), [len(c) for c in columns])
        col = np.concatenate([np.zeros(0, int), *columns])
        values = ratio[kept]
        weights, self.intercept = fit_sparse(row, col, values[col], y, int(kept.sum()))
        self.weights = np.zeros(size)
        self.weights[kept] = weights * values

    def score(self, text: str) -> float:
        known = self.weights != 0
        found = [hashes[known[hashes]] for hashes in ngrams(text)]
        held = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)
        return float(sigmoid(self.weights[held].sum() + self.intercept))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = SAMPLE) -> Model:
    return Model(labelled(docs, labels, label, FOLDS, HELD_OUT, limit))


def score(text: Column, model: Model, spark: SparkSession) -> Column:
    """How likely each whole text is toxic, 0 to 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        fitted = shared.value
        return pa.array([fitted.score(t.as_py() or "") for t in texts], pa.float64())

    return scored(text)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    docs = documents(spark, folder)
    model = fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return docs.select(
        "doc_id",
        F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        score(F.col("text"), model, spark).alias("score"),
    ).withColumn("predicted", (F.col("score") >= CUTOFF).cast("int"))
