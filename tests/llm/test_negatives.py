"""Hard negatives against brute force in whole numbers, and the bounds against the scores."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterhouse.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id string, vector int, norm int, block int, rank int"


def brute_force(rows):
    kept = {}
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(256 * x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        kept[vec_id] = min(kept.get(vec_id, (label, vector)), (label, vector))
    whole = {i: (label, [math.floor(256 * x) for x in vector]) for i, (label, vector) in kept.items()}
    most, out = negatives.LONGEST, []
    for a, (label, v) in whole.items():
        if a % 50:
            continue
        of = {
            i: max(-most, min(most, sum(x * y for x, y in zip(v, w, strict=False))))
            for i, (_, w) in whole.items() if i != a
        }
        order = sorted(of, key=lambda i: (-of[i], i))
        for p in [i for i in order if whole[i][0] == label][:5]:
            inside = [
                i for i in order
                if whole[i][0] != label and 50 * of[p] <= 100 * of[i] <= 95 * of[p]
            ]
            out += [(a, p, n, i, of[p], of[i]) for n, i in enumerate(inside[:3], 1)]
    return sorted(out)


def mined(spark, rows, **settings):
    df = spark.createDataFrame(rows, SCHEMA)
    moved = F.when(df["vec_id"] % 7 == 0, (df["label"] + 1) % 10).otherwise(df["label"])
    usable = negatives.usable(df, "embedding", df["vec_id"], moved)
    found = negatives.mine(usable, F.col("id") % 50 == 0, **settings)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def extra(*row):
    return (*row, "x", 1, 2, 3, 4)


def vectors(kind, count, width, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = []
    for n in range(count):
        if kind == "clustered":
            v = [c + rng.gauss(0, 0.1) for c in rng.choice(centres)]
        elif kind == "coarse":  # many equal scores
            v = [rng.randint(-1, 2) / 2 for _ in range(width)]
        elif kind == "long":  # products beyond 2**53, some beyond a long
            v = [rng.gauss(0, 1) * 10 ** rng.randint(0, 8) for _ in range(width)]
        else:
            v = [rng.random() for _ in range(width)]
        rows.append(extra(n, v, rng.randint(0, 3)))
    return rows


@pytest.mark.parametrize("kind", ["plain", "clustered", "coarse", "long"])
def test_equals_brute_force(spark, kind):
    rows = vectors(kind, 260, 12, kind)
    expected = brute_force(rows)
    assert mined(spark, rows) == expected and len(expected) > 20
    assert mined(spark, rows, block_bytes=3_000) == expected


def test_awkward_rows(spark):
    rows = vectors("plain", 120, 5, 1)
    rows += rows[:30]  # repeated
    rows += [extra(50, [0.1] * 5, 1), extra(100, None, 1), extra(None, [0.1] * 5, 1), extra(300, [0.1] * 5, None)]
    rows += [extra(301, [0.1, None], 1), extra(302, [float("nan")] * 5, 1), extra(303, [float("inf")] * 5, 1)]
    rows += [extra(304, [1e308] * 5, 1), extra(350, [], 1), extra(351, [0.5], 2), extra(400, [0.0] * 5, 0)]
    rows += [extra(-50, [-0.5] * 5, 0), extra(500, [0.5] * 9, 2)]
    assert mined(spark, rows) == brute_force(rows)
    assert mined(spark, rows[:1]) == [] and mined(spark, rows[:1] * 3) == []
    assert mined(spark, [extra(0, [], 1), extra(1, [], 2), extra(2, [], 3)]) == [(0, 1, 1, 2, 0, 0)]
    empty = spark.createDataFrame([], SCHEMA)
    usable = negatives.usable(empty, "embedding", empty["vec_id"], empty["label"])
    assert negatives.mine(usable, F.col("id") % 50 == 0).collect() == []


def test_one_vector_in_a_third_of_the_rows(spark):
    rows = vectors("clustered", 300, 8, 2)
    rows = [(r[0], rows[0][1], *r[2:]) if r[0] % 3 == 0 else r for r in rows]
    assert mined(spark, rows) == brute_force(rows)


@pytest.mark.parametrize("kind", ["plain", "clustered", "coarse", "long"])
def test_bounds_hold_and_leave_rows_out(kind):
    matrix = np.floor(np.array([r[1] for r in vectors(kind, 400, 12, kind)]) * 256)
    norms = negatives.norms_of(matrix)
    references = negatives.directions(matrix)
    assert np.allclose(np.linalg.norm(references, axis=1), 1) and len(references) == negatives.REFERENCES
    table = pa.table({
        "id": pa.array(range(400)), "label": pa.array([0] * 400), "norm": pa.array(norms),
        "vector": negatives.listed(matrix),
        "angles": negatives.listed(negatives.angles_of(matrix, norms, references)),
    })
    block = negatives.Block(table, 12)
    low, high = negatives.score_bounds(block, block)
    exact = matrix.astype(object) @ matrix.astype(object).T
    inside = [low[i, j] <= exact[i, j] <= high[i, j] or abs(exact[i, j]) > 2**63 for i in range(400) for j in range(400)]
    assert all(inside)
    if kind == "clustered":  # reference rows lie in the clusters, so intervals are narrow
        assert (high < 0.5 * norms[:, None] * norms).mean() > 0.3

