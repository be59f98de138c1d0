"""Ordered chains: a small state carried through all rows of a key, however many one key has.

Spark brings the rows of a key together in order and a scan walks over them batch by batch, so no task
holds more than a batch. Keys of more rows than one task should own are cut into ordered pieces by range
partitioning, balanced by row count, and the state is carried from piece to piece; the first pieces of
all such keys run at once, then the second ones, and so on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterhouse.session import write_and_read

LONG_ROWS = 5_000_000  # rows of one key, above which they are cut into pieces
PIECE_ROWS = 5_000_000
SMALL_TASK_ROWS = 10_000  # below this a task costs more to start than to run

Carry = Callable[[DataFrame, DataFrame], DataFrame]


def _tasks(df: DataFrame, rows: int, piece_rows: int) -> int:
    small = min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // SMALL_TASK_ROWS))
    return max(1, small, -(-rows // piece_rows))


def _walk(rows: DataFrame, state: DataFrame, key: str, order: list[str], scan, schema: str, tasks: int):
    """The hint keeps the join on the partitioning by key, which the scan relies on."""
    return (
        rows.repartition(tasks, key)
        .join(state.hint("shuffle_hash"), key)
        .sortWithinPartitions(key, *order)
        .mapInArrow(scan, schema)
    )


def walk_chains(
    rows: DataFrame,
    state: DataFrame,
    key: str,
    order: list[str],
    scan: Callable,
    schema: str,
    carry: Carry,
    long_rows: int = LONG_ROWS,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """What ``scan`` makes of ``rows`` joined to ``state``, sorted by ``key`` and ``order``; written.

    ``rows`` is a written table; ``order`` tells the rows of a key apart. ``state`` has one row for each
    key. ``carry(state, done)`` gives the state after the rows that the scan returned as ``done``.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("_n"))
    is_long = F.col("_n") > long_rows
    total = sizes.agg(F.sum("_n").alias("all"), F.sum(F.when(is_long, F.col("_n"))).alias("long")).first()
    count, in_long = total["all"] or 0, total["long"] or 0
    if not in_long:
        tasks = _tasks(rows, count, piece_rows)
        return write_and_read(_walk(rows, state, key, order, scan, schema, tasks), "chains")

    long = write_and_read(sizes.where(is_long).select(key), "long-chains")
    short = rows.join(long, key, "left_anti")
    tasks = _tasks(rows, count - in_long, piece_rows)
    done = write_and_read(_walk(short, state, key, order, scan, schema, tasks), "chains")
    # written down, as a sampled range may move when it is computed again
    n = -(-in_long // piece_rows)
    ranged = rows.join(long, key, "left_semi").repartitionByRange(n, key, *order)
    cut = write_and_read(ranged.withColumn("_range", F.spark_partition_id()), "chain-ranges")
    place = Window.partitionBy(key).orderBy("_range")
    # one row for each key and range it reaches into
    pieces = cut.select(key, "_range").distinct().withColumn("_piece", F.row_number().over(place))
    placed = cut.join(write_and_read(pieces, "chain-pieces"), [key, "_range"]).drop("_range")
    placed = write_and_read(placed, "chain-pieces", ["_piece"])  # a round reads its own pieces only
    rounds = placed.groupBy("_piece").agg(F.count("*").alias("n")).orderBy("_piece").collect()
    state = state.join(long, key, "left_semi")
    for piece, size in rounds:
        mine = placed.where(F.col("_piece") == piece).drop("_piece")
        walked = _walk(mine, state, key, order, scan, schema, _tasks(rows, size, piece_rows))
        walked = write_and_read(walked, "chains")
        done = done.unionByName(walked)
        if piece < len(rounds):
            state = write_and_read(carry(state, walked), "chain-state")
    return done
