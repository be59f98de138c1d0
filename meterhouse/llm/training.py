"""Bounded samples of labelled rows, and the logistic regressions fitted to them."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterhouse.llm.tables import fold_of

LONGEST = 20_000  # characters of a text that is learned from


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, limit: int
) -> list[tuple[str, int]]:
    """At most ``limit`` (text, label) pairs, in an order that depends on the ids only.

    Rows of the fold ``held_out``, null labels, ids labelled both ways and texts longer than
    ``LONGEST`` are left out. What is collected is bounded by ``limit`` texts of that length.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & (fold_of(F.col("doc_id"), folds) != held_out))
        .groupBy("doc_id")
        .agg(F.min(label).alias("low"), F.max(label).alias("high"))
        .where("low = high")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    texts = (
        docs.select("doc_id", "text")
        .where(F.length("text") <= LONGEST)
        .join(F.broadcast(chosen), "doc_id")  # ``limit`` ids
        .groupBy("doc_id", "low")
        .agg(F.max("text").alias("text"))
    )
    rows = texts.select("doc_id", "text", "low").collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id))
    return [(r.text, int(r.low)) for r in rows]


def fit_dense(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression, the intercept first, by Newton steps."""
    if len(x) == 0 or y.min() == y.max():
        return np.zeros(x.shape[1] + 1) + (np.eye(x.shape[1] + 1)[0] * prior(y))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = sigmoid(a @ w)
        hessian = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)) * len(x) / 1000
        w += np.linalg.solve(hessian, a.T @ (y - p) - ridge * w * len(x) / 1000)
    slopes = w[1:] / scale
    return np.concatenate(([w[0] - slopes @ mean], slopes))


def fit_sparse(
    row: np.ndarray, col: np.ndarray, value: np.ndarray, y: np.ndarray, width: int,
    ridge: float = 1e-4, steps: int = 600,
) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression on entries (row, col, value)."""
    if len(col) == 0 or y.min() == y.max():
        return np.zeros(width), prior(y)
    n, u = len(y), np.ones(width)
    top = 1.0
    for _ in range(20):  # largest curvature, by power iteration
        u = np.bincount(col, value * np.bincount(row, value * u[col], n)[row], width)
        top = np.linalg.norm(u) + 1e-12
        u /= top
    step = 1 / (top / 4 / n + ridge)
    w, ahead, b, t = np.zeros(width), np.zeros(width), prior(y), 1.0
    for _ in range(steps):
        error = sigmoid(np.bincount(row, value * ahead[col], n) + b) - y
        new = ahead - step * (np.bincount(col, value * error[row], width) / n + ridge * ahead)
        b -= 2 * error.mean()
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / after * (new - w), new, after
    return w, b


def prior(y: np.ndarray) -> float:
    """Log odds of label 1, one row of each label added."""
    return float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
