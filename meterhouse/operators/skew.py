"""Ordered per-key work that stays parallel when one key holds a large share of the rows.

A plain ``lag``/``lead`` window sorts all rows of a key in one task. Here a key above a threshold
is cut into slices along its order column, the window runs per (key, slice), and only the first or
last row of each slice crosses to its neighbour. The result is the same for any slicing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterhouse.session import write_and_read

HOT_ROWS = 1_000_000  # rows one task may sort for a single key, however many there are in all
LEAST_SLICES = 16
BLOCK = 16
SMALL = 1_000_000  # bounds of hot keys that are sent to every task; more of them are joined

SLICE = "_slice"


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, small: bool = False
) -> DataFrame:
    """Join on equal keys where NULL equals NULL; the right keys are dropped."""
    other = right.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = left.join(F.broadcast(other) if small else other, match, how)
    return joined.drop(*[f"_k_{k}" for k in keys])


@dataclass
class HotKeys:
    """Keys too large for one task, as a written table (keys, ``_bounds``), and whether it is small."""

    bounds: DataFrame
    keys: list[str]
    small: bool

    def only(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` with a hot key."""
        return null_safe_join(df, self.bounds.select(*self.keys), self.keys, "left_semi", self.small)

    def attach(self, df: DataFrame, extra: DataFrame) -> DataFrame:
        """Left join of ``df`` with one row for each slice of a hot key."""
        return null_safe_join(df, extra, [*self.keys, SLICE], "left", self.small)


def hot_keys(
    df: DataFrame, keys: list[str], order: str, min_rows: int = HOT_ROWS, slices: int | None = None
) -> HotKeys | None:
    """Keys of more than ``min_rows`` rows, NULL keys included, with their slice bounds; or None.

    A slice has about ``min_rows`` rows: the largest key decides how many slices a hot key is cut
    into, unless ``slices`` does. Runs a count at once, then one for each key and, if there are hot
    keys, one for their quantiles, and writes these down.
    """
    if df.count() <= min_rows:
        return None
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > min_rows)
    hot = write_and_read(counts, "hot-counts")
    number, largest = hot.agg(F.count("*"), F.max("_n")).first()
    if not number:
        return None
    slices = slices or max(LEAST_SLICES, -(-largest // min_rows))
    cuts = [i / slices for i in range(1, slices)]
    small = number * slices <= SMALL
    bounds = (
        null_safe_join(df, hot.select(*keys), keys, "left_semi", small)
        .groupBy(*keys)
        .agg(F.percentile_approx(order, cuts, max(10_000, 10 * slices)).alias("_bounds"))
    )
    return HotKeys(write_and_read(bounds, "hot-keys"), keys, small)


def with_slice(df: DataFrame, keys: list[str], order: str, hot: HotKeys | None) -> DataFrame:
    """Adds ``_slice``, a number that never falls along ``order`` within a key; 0 for other keys."""
    if hot is None:
        return df.withColumn(SLICE, F.lit(0))
    # the number of bounds below a row: first by every BLOCK-th bound, then within that block
    coarse = F.filter("_bounds", lambda b, i: (i + 1) % BLOCK == 0)
    lookup = hot.bounds.withColumn("_coarse", coarse)
    block = F.slice("_bounds", F.col("_block") * BLOCK + 1, BLOCK - 1)
    return (
        null_safe_join(df, lookup, keys, "left", hot.small)
        .withColumn("_block", F.size(F.filter("_coarse", lambda b: b < F.col(order))))
        .withColumn(
            SLICE,
            F.when(F.col("_bounds").isNull(), 0).otherwise(
                F.col("_block") * BLOCK + F.size(F.filter(block, lambda b: b < F.col(order)))
            ),
        )
        .drop("_bounds", "_coarse", "_block")
    )


def neighbour(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    out: str,
    hot: HotKeys | None = None,
    back: bool = False,
) -> DataFrame:
    """``lead`` (or ``lag`` with ``back``) of ``value`` within ``keys`` along ``order``.

    With hot keys the frame must carry ``_slice`` (see ``with_slice``), cut along ``order[0]``.
    """
    step = F.lag if back else F.lead
    if hot is None:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(out, step(value).over(window))

    window = Window.partitionBy(*keys, SLICE).orderBy(*order)
    edge = F.max_by if back else F.min_by
    edges = (
        hot.only(df)
        .groupBy(*keys, SLICE)
        .agg(edge(F.struct(value.alias("v")), F.struct(*order)).alias("_edge"))
    )
    across = Window.partitionBy(*keys).orderBy(SLICE)
    # one row for each slice of a hot key
    crossing = edges.select(*keys, SLICE, step("_edge").over(across).alias("_edge"))
    here = df.withColumn("_here", step(F.struct(value.alias("v"))).over(window))
    return (
        hot.attach(here, crossing)
        .withColumn(out, F.coalesce("_here", "_edge")["v"])
        .drop("_here", "_edge")
    )


def running_sum(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    out: str,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Sum of ``value`` from the first row of a key up to each row; frame as for ``neighbour``."""
    upto = (Window.unboundedPreceding, Window.currentRow)
    if hot is None:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)
        return df.withColumn(out, F.sum(value).over(window))

    window = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(*upto)
    totals = (
        hot.only(df)
        .groupBy(*keys, SLICE)
        .agg(F.sum(value).alias("_total"))
    )
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # one row for each slice of a hot key
    offsets = totals.select(*keys, SLICE, F.sum("_total").over(before).alias("_before"))
    return (
        hot.attach(df.withColumn("_here", F.sum(value).over(window)), offsets)
        .withColumn(out, F.col("_here") + F.coalesce("_before", F.lit(0)))
        .drop("_here", "_before")
    )


def number_rows(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Numbers all rows 1, 2, 3, ... along ``order`` without bringing them into one task.

    Rows are range-partitioned and counted per partition; each partition starts at the count of the
    ones before it. The partitioning is written down, as a sampled range may move when recomputed.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.spark_partition_id())
    )
    placed = write_and_read(placed, "numbered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
        .select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_id") - F.col("_first") + F.col("_before") + 1)
        .drop("_id", "_part", "_first", "_before")
    )
