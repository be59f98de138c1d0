"""Quality: a compression classifier with zstandard dictionaries of good and bad text.

A text is compressed three times, a chunk after the other: with a dictionary of pieces of good texts,
with one of bad texts, and with none. The difference of the first two sizes over the larger one says
whose company the text resembles; the size without dictionary over the plain length, and the length,
say how far that difference can be trusted. A logistic regression turns them into a calibrated score.

At most ``SAMPLE`` labelled texts are learned from: up to ``DICTIONARY_TEXTS`` of each label, one piece
of each, for the dictionaries (at most half of the texts of a label), the others for the calibration.
Whole texts are scored, row by row, so scoring shuffles nothing.

A null or empty text has difference zero, and gets the score that goes with that. Null ids count as
not held out. Repeated rows are scored alike; further columns pass through. Without labels the score
is 0.5, and with labels of one kind it is their smoothed share.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhouse.llm.tables import documents, fold_of, fresh
from meterhouse.llm.training import fit_dense, labelled, sigmoid

SAMPLE = 6_000
DICTIONARY_TEXTS = 300
PIECE = 4_000  # bytes
LEVEL = 6
CHUNK = 65_536  # bytes
FOLDS, HELD_OUT, CUTOFF = 3, 1, 0.5


def piece(text: str) -> bytes:
    """One of the pieces of a text, chosen by its checksum."""
    data = text.encode("utf-8", "replace")
    return data[zlib.crc32(data) % (len(data) // PIECE + 1) * PIECE :][:PIECE]


class Sizes:
    """Compressors of one task."""

    def __init__(self, good: bytes, bad: bytes):
        self.compressors = [zstandard.ZstdCompressor(level=LEVEL)]
        for content in (good, bad):
            if len(content) < 8:  # nothing to resemble
                self.compressors.append(self.compressors[0])
                continue
            words = zstandard.ZstdCompressionDict(
                content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            words.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=words))

    def features(self, text: str) -> tuple[float, float, float]:
        data = text.encode("utf-8", "replace")
        if not data:
            return 0.0, 1.0, 0.0
        plain, good, bad = (
            sum(len(c.compress(data[at : at + CHUNK])) for at in range(0, len(data), CHUNK))
            for c in self.compressors
        )
        return (bad - good) / max(bad, good), plain / len(data), float(np.log1p(len(data)))


class Model:
    def __init__(self, rows: list[tuple[str, int]]):
        content, rest = {0: [], 1: []}, []
        share = {k: min(DICTIONARY_TEXTS, sum(y == k for _, y in rows) // 2) for k in (0, 1)}
        for text, label in rows:
            if len(content[label]) < share[label]:
                content[label].append(piece(text))
            else:
                rest.append((text, label))
        self.good, self.bad = b"\n".join(content[1]), b"\n".join(content[0])
        sizes = Sizes(self.good, self.bad)
        x = np.array([sizes.features(text) for text, _ in rest]).reshape(-1, 3)
        self.weights = fit_dense(x, np.array([y for _, y in rest], float))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        sizes = Sizes(self.good, self.bad)
        x = np.array([sizes.features(t or "") for t in texts]).reshape(-1, 3)
        return sigmoid(self.weights[0] + x @ self.weights[1:])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = SAMPLE) -> Model:
    return Model(labelled(docs, labels, label, FOLDS, HELD_OUT, limit))


def score(text: Column, model: Model, spark: SparkSession) -> Column:
    """How likely each whole text is good, 0 to 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(texts.to_pylist()), pa.float64())

    return scored(text)


def only_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` with a score of at least ``CUTOFF``, with their columns."""
    name = fresh(docs, "quality")
    scored = docs.withColumn(name, score(F.col("text"), fit(docs, labels), docs.sparkSession))
    return scored.where(F.col(name) >= CUTOFF).drop(name)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    docs = documents(spark, folder)
    model = fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return docs.select(
        "doc_id",
        F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        score(F.col("text"), model, spark).alias("score"),
    ).withColumn("predicted", (F.col("score") >= CUTOFF).cast("int"))
