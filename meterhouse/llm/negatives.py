"""Hard-negative mining: inner products bounded by angles to reference directions, then counted exactly.

Anchors are scored against all rows in whole numbers: every component x becomes floor(256 * x), and a
score is the inner product of two such vectors. Higher scores come first, ties by smaller id. An anchor's
positives are its first rows of the same label; for each positive, its negatives are the first rows of
other labels whose score lies in the positive's window, from ``LOW`` to ``HIGH`` percent of its score.

* **Angles.** Every row stores its norm and its angles to a few reference directions, rows spread out
  over a bounded sample. The angle of two rows differs from each reference by at most the triangle
  inequality on the sphere, which gives an interval for their cosine; the narrowest, times both norms and
  widened by what rounding can move, bounds the score. Only rows whose interval meets what an anchor
  still looks for get a score.
* **Blocks.** Anchors go out in blocks of at most ``BLOCK_BYTES``, one pass over the rows for each; a
  task keeps the best few rows of each anchor, and only those are shuffled. No pairs are stored.
* **Whole numbers.** Vectors whose products fit are multiplied as doubles, which is exact below 2**53;
  longer ones as Python's integers. A score beyond a long counts as the last long on that side.

Rows with a null id, label or vector, or a component that is null or not finite (256 times it included),
take no part. Of rows with the same id the first by label, then vector takes part. Vectors of unequal
length are taken as ending in zeros. Anchors without positives, and positives without negatives, give no
rows; nor does an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterhouse.session import work_folder, write_and_read

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # percent of the positive's score
REFERENCES = 16
SAMPLE = 2_000  # rows that the references are chosen from
BLOCK_BYTES = 32 << 20  # of anchors sent out at once
TILE_ROWS, TILE_ANCHORS = 2_048, 32  # bounds of a tile stay in a cache
EXACT = 2.0**53
SLACK = 1e-7  # of the norms' product: more than rounded angles and norms can move a bound

LONGEST = (1 << 63) - 1

ROWS_SCHEMA = "id long, label long, vector array<double>, norm double, angles array<double>"
FOUND_SCHEMA = "anchor_id long, slot int, id long, score long"
RESULT_SCHEMA = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def usable(rows: DataFrame, vector: str, id_: Column, label: Column) -> DataFrame:
    """(id, label, vector) of the rows that take part, one for each id."""
    finite = F.forall(
        F.col(vector),
        lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) < float("inf"), F.lit(False)),
    )
    row = F.struct(label.cast("long").alias("label"), F.col(vector).alias("vector"))
    return (
        rows.where(id_.isNotNull() & label.isNotNull() & finite)
        .select(id_.cast("long").alias("id"), row.alias("row"))
        .groupBy("id")
        .agg(F.min("row").alias("row"))
        .select("id", "row.label", F.col("row.vector").cast("array<double>").alias("vector"))
    )


def matrix_of(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as the rows of a matrix, ended with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def listed(matrix: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(matrix.shape[1])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))


def norms_of(vectors: np.ndarray) -> np.ndarray:
    most = np.abs(vectors).max(axis=1, initial=0.0)
    scale = np.where(most > 0, most, 1.0)
    return np.sqrt(((vectors / scale[:, None]) ** 2).sum(axis=1)) * scale


def directions(vectors: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Unit vectors of a sample, each the one whose nearest chosen direction is farthest off."""
    norm = norms_of(vectors)
    units = vectors[norm > 0] / norm[norm > 0, None]
    if not len(units):
        return np.zeros((0, vectors.shape[1]))
    chosen = [0]
    near = units @ units[0]
    while len(chosen) < min(count, len(units)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, units @ units[chosen[-1]])
    return units[chosen]


def angles_of(vectors: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    units = vectors / np.where(norms > 0, norms, 1.0)[:, None]
    return np.arccos(np.clip(units @ references.T, -1.0, 1.0))


def with_angles(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` in whole numbers, with norms and angles to the reference directions; a written table."""
    taken = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow()
    sample = matrix_of(pa.concat_arrays(taken["vector"].chunks), width)
    references = directions(np.floor(sample * SCALE))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = np.floor(matrix_of(batch["vector"], width) * SCALE)
            norms = norms_of(vectors)
            angles = angles_of(vectors, norms, references)
            columns = [batch["id"], batch["label"], listed(vectors), pa.array(norms), listed(angles)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "vector", "norm", "angles"])

    return write_and_read(rows.mapInArrow(add, ROWS_SCHEMA), "angles")


class Block:
    """Vectors with ids, labels, norms and angles, as arrays."""

    def __init__(self, table, width: int):
        def flat(name):
            column = table[name]
            return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column

        self.ids = flat("id").to_numpy(zero_copy_only=False)
        self.labels = flat("label").to_numpy(zero_copy_only=False)
        self.norms = flat("norm").to_numpy(zero_copy_only=False)
        self.vectors = matrix_of(flat("vector"), width)
        lengths = flat("angles").value_lengths().to_numpy(zero_copy_only=False)
        angles = matrix_of(flat("angles"), int(lengths[0]) if len(lengths) else 0)
        self.cos, self.sin = np.cos(angles), np.sin(angles)

    def part(self, at: slice | np.ndarray) -> "Block":
        out = object.__new__(Block)
        for name, value in vars(self).items():
            setattr(out, name, value[at])
        return out


def score_bounds(a: Block, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers that no score of ``a`` with ``b`` lies below or above.

    With angles s and t to a reference, the rows' own angle lies between |s - t| and s + t, so its cosine
    lies between cos(s + t) and cos(s - t).
    """
    low, high = np.full((len(a.ids), len(b.ids)), -1.0), np.ones((len(a.ids), len(b.ids)))
    for k in range(a.cos.shape[1]):
        near = np.multiply.outer(a.cos[:, k], b.cos[:, k])
        far = np.multiply.outer(a.sin[:, k], b.sin[:, k])
        np.minimum(high, near + far, out=high)
        np.maximum(low, near - far, out=low)
    norms = np.multiply.outer(a.norms, b.norms)
    with np.errstate(over="ignore", invalid="ignore"):
        low, high = np.ceil((low - SLACK) * norms), np.floor((high + SLACK) * norms)
    known = np.isfinite(norms)
    low, high = np.where(known, low, -np.inf), np.where(known, high, np.inf)
    return np.clip(low, -(2.0**63), 2.0**63), np.clip(high, -(2.0**63), 2.0**63)


def scores(vector: np.ndarray, norm: float, others: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Exact inner products, cut off at the ends of a long."""
    fits = norm * norms < EXACT / 2
    out = np.zeros(len(others), np.int64)
    out[fits] = (others[fits] @ vector).astype(np.int64)
    for n in np.flatnonzero(~fits):
        exact = sum(int(x) * int(y) for x, y in zip(vector, others[n], strict=True))
        out[n] = max(-LONGEST, min(LONGEST, exact))
    return out


def first(score: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` highest scores, ties by smaller id."""
    if len(score) > 16 * count:
        some = np.flatnonzero(score >= np.partition(score, len(score) - count)[len(score) - count])
        return some[np.lexsort((ids[some], -score[some]))[:count]]
    return np.lexsort((ids, -score))[:count]


def outward(value: int, to: float) -> float:
    """``value`` as a double that rounding has not moved inward."""
    return float(np.nextafter(float(value), to))


class Best:
    """The first few rows found so far for each anchor and slot."""

    def __init__(self, anchors: int, slots: int, count: int):
        self.count = count
        self.kept: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.least = np.full((anchors, slots), -np.inf)  # a lower score can no longer enter

    def add(self, anchor: int, slot: int, score: np.ndarray, ids: np.ndarray) -> None:
        old = self.kept.get((anchor, slot))
        if old is not None:
            score, ids = np.concatenate([old[0], score]), np.concatenate([old[1], ids])
        at = first(score, ids, self.count)
        self.kept[anchor, slot] = score[at], ids[at]
        if len(at) == self.count:
            self.least[anchor, slot] = outward(int(score[at[-1]]), -np.inf)

    def batch(self, anchor_ids: np.ndarray) -> pa.RecordBatch:
        """All kept rows, at most ``count`` for each anchor and slot."""
        found = list(self.kept.items())
        sizes = np.array([len(ids) for _, (_, ids) in found], np.int64)
        anchors = np.array([anchor_ids[a] for (a, _), _ in found], np.int64)
        slots = np.array([slot for (_, slot), _ in found], np.int32)
        empty = [np.zeros(0, np.int64)]
        ids = np.concatenate([ids for _, (_, ids) in found] or empty)
        score = np.concatenate([score for _, (score, _) in found] or empty)
        columns = [np.repeat(anchors, sizes), np.repeat(slots, sizes), ids, score]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], ["anchor_id", "slot", "id", "score"]
        )


def tiles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Block]:
    for batch in batches:
        for at in range(0, batch.num_rows, TILE_ROWS):
            yield Block(batch.slice(at, TILE_ROWS), width)


def positives_in(block: Broadcast, width: int, count: int):
    """Finds, in each task, the first ``count`` rows of the same label for each anchor of a block."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Block = block.value[0]
        best = Best(len(anchors.ids), 1, count)
        of = {label: np.flatnonzero(anchors.labels == label) for label in np.unique(anchors.labels)}
        for tile in tiles(batches, width):
            for label in np.intersect1d(tile.labels, anchors.labels):  # other labels get no bounds
                rows = tile.part(tile.labels == label)
                for at in range(0, len(of[label]), TILE_ANCHORS):
                    places = of[label][at : at + TILE_ANCHORS]
                    some = anchors.part(places)
                    wanted = score_bounds(some, rows)[1] >= best.least[places]
                    wanted &= some.ids[:, None] != rows.ids
                    for n in np.flatnonzero(wanted.any(axis=1)):
                        hit = np.flatnonzero(wanted[n])
                        score = scores(some.vectors[n], some.norms[n], rows.vectors[hit], rows.norms[hit])
                        best.add(places[n], 0, score, rows.ids[hit])
        yield best.batch(anchors.ids)

    return find


def negatives_in(block: Broadcast, width: int, count: int):
    """Finds, in each task, the first ``count`` rows of other labels in each window of each anchor."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, low, high, exact = block.value
        slots = low.shape[1]
        best = Best(len(anchors.ids), slots, count)
        for rows in tiles(batches, width):
            for at in range(0, len(anchors.ids), TILE_ANCHORS):
                part = slice(at, at + TILE_ANCHORS)
                some = anchors.part(part)
                least, most = score_bounds(some, rows)
                open_ = np.zeros(least.shape, bool)
                for slot in range(slots):  # windows that the interval meets and that can still change
                    from_ = np.maximum(low[part, slot], best.least[part, slot])
                    open_ |= (most >= from_[:, None]) & (least <= high[part, slot][:, None])
                open_ &= some.labels[:, None] != rows.labels
                for n in np.flatnonzero(open_.any(axis=1)):
                    hit = np.flatnonzero(open_[n])
                    score = scores(some.vectors[n], some.norms[n], rows.vectors[hit], rows.norms[hit])
                    for slot, (bottom, top) in enumerate(exact[at + n]):
                        enters = (score >= bottom) & (score <= top) & (score >= best.least[at + n, slot])
                        inside = np.flatnonzero(enters)
                        if len(inside):
                            best.add(at + n, slot, score[inside], rows.ids[hit[inside]])
        yield best.batch(anchors.ids)

    return find


def first_of_all(found: DataFrame, count: int) -> DataFrame:
    """The first ``count`` rows of each anchor and slot over all tasks, numbered from 1."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def window_of(score: int) -> tuple[int, int]:
    """Least and greatest score of a negative of a positive with ``score``."""
    return -(-LOW * score // 100), HIGH * score // 100


def windows_of(anchors: Block, found: list) -> tuple[np.ndarray, np.ndarray, list[list[tuple[int, int]]]]:
    """Windows of each anchor's positives, as doubles moved outward and exactly; shut where there is none."""
    place = {int(i): n for n, i in enumerate(anchors.ids)}
    low = np.full((len(place), POSITIVES), np.inf)
    high = np.full((len(place), POSITIVES), -np.inf)
    exact = [[(1, 0)] * POSITIVES for _ in place]
    for r in found:
        n, slot = place[r.anchor_id], r.rank - 1
        exact[n][slot] = bottom, top = window_of(r.score)
        low[n, slot], high[n, slot] = outward(bottom, -np.inf), outward(top, np.inf)
    return low, high, exact


def mine(rows: DataFrame, is_anchor: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Negatives of each positive of the anchors among ``rows`` (id, label, vector), ids unique.

    The rows that ``is_anchor`` selects are dealt by a hash of the id into blocks of half of
    ``block_bytes`` on average; a block and its positives are all that is sent out at a time.
    """
    spark = rows.sparkSession
    rows = write_and_read(rows, "vectors")
    width = rows.agg(F.max(F.size("vector")).alias("width")).first().width or 0
    rows = with_angles(rows, width) if not rows.isEmpty() else spark.createDataFrame([], ROWS_SCHEMA)
    anchors = rows.where(is_anchor)
    row_bytes = 8 * (width + 2 * REFERENCES + 3 + 4 * POSITIVES)
    blocks = -(-anchors.count() * row_bytes * 2 // block_bytes)
    out = work_folder(spark, "negatives")
    for n in range(blocks):
        mine_ = anchors.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == n).toArrow()
        if mine_.num_rows == 0:
            continue
        block = Block(mine_, width)
        sent = spark.sparkContext.broadcast((block,))
        found = rows.mapInArrow(positives_in(sent, width, POSITIVES), FOUND_SCHEMA)
        positives = write_and_read(first_of_all(found, POSITIVES), "positives")
        windows = windows_of(block, positives.collect())  # a few for each anchor of the block
        sent.unpersist()
        sent = spark.sparkContext.broadcast((block, *windows))
        found = rows.mapInArrow(negatives_in(sent, width, NEGATIVES), FOUND_SCHEMA)
        of = positives.select(
            "anchor_id", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        )
        first_of_all(found, NEGATIVES).join(of, ["anchor_id", "slot"]).select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        ).write.parquet(f"{out}/block={n}")
        sent.unpersist()
    if not blocks:
        return spark.createDataFrame([], RESULT_SCHEMA)
    return spark.read.schema(f"{RESULT_SCHEMA}, block int").parquet(out).drop("block")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every fiftieth row, labels of every seventh moved on by one."""
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(usable(rows, "embedding", vec_id, moved), F.col("id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, embedding,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY 2, embedding) = 1),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
    list_dot_product(a.q, r.q)::BIGINT AS score
  FROM v AS a JOIN v AS r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
