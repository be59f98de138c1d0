"""Lookups in a dimension as it stood when an event happened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterhouse.operators.history import END, START
from meterhouse.operators.skew import SLICE, hot_keys, with_slice

BROADCAST_VERSIONS = 10_000  # versions sent to every task, and tried per event at the very worst


def as_of_join(
    events: DataFrame,
    history: DataFrame,
    keys: list[str],
    ts: str,
    columns: list[str],
    broadcast_versions: int = BROADCAST_VERSIONS,
    hot_rows: int | None = None,
) -> DataFrame:
    """Left join of events with the one version valid at ``ts``; NULLs where there is none.

    A NULL key never matches. Where versions overlap, the last to start holds until it ends or the next
    starts; of versions that start together, the last to end. Both ways below keep to that.

    A history of few versions is fetched, which proves its size, and broadcast; the events stay
    where they are. A longer one is merged with the events in time order, which touches every row
    once however many versions a key has.
    """
    history = history.select(*keys, *columns, START, END)
    few = history.limit(broadcast_versions + 1).toArrow()
    if few.num_rows <= broadcast_versions:
        fetched = events.sparkSession.createDataFrame(few, history.schema)
        return as_of_broadcast(events, fetched, keys, ts, columns)
    return as_of_merge(events, history, keys, ts, columns, hot_rows)


def _version_order(columns: list[str], inside: str = "") -> list[Column]:
    """Versions by start, then end, open ones last; ``inside`` names the struct that holds them."""
    start = [] if inside else [F.col(START)]
    of = f"{inside}." if inside else ""
    return [*start, F.col(f"{of}{END}").asc_nulls_last(), *[F.col(f"{of}{c}") for c in columns]]


def as_of_broadcast(
    events: DataFrame, history: DataFrame, keys: list[str], ts: str, columns: list[str]
) -> DataFrame:
    """Hash join on the keys with the interval as a residual condition; no shuffle of the events."""
    window = Window.partitionBy(*keys).orderBy(*_version_order(columns))
    next_start = F.lead(START).over(window)
    history = history.withColumn("_next", next_start).where(f"_next IS NULL OR _next > {START}")
    end = F.least(END, "_next")  # the one that is not NULL, if only one is
    lookup = history.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *columns, START, end.alias(END))
    match = (F.col(START) <= F.col(ts)) & (F.col(END).isNull() | (F.col(ts) < F.col(END)))
    for k in keys:
        match = match & (F.col(k) == F.col(f"_k_{k}"))
    return events.join(F.broadcast(lookup), match, "left").drop(
        *[f"_k_{k}" for k in keys], START, END
    )


def as_of_merge(
    events: DataFrame,
    history: DataFrame,
    keys: list[str],
    ts: str,
    columns: list[str],
    hot_rows: int | None = None,
) -> DataFrame:
    """Events and versions in one time order per key; each event takes the last version before it.

    Hot keys are cut into slices along the time; a slice without a version of its own takes the last
    one of the slices before it. The history is read several times, so pass a stored one.
    """
    version = F.struct(*columns, END)
    left = events.select(
        *keys, F.col(ts).alias("_at"), F.lit(1).alias("_kind"), F.struct(*events.columns).alias("_e")
    )
    right = history.select(
        *keys, F.col(START).alias("_at"), F.lit(0).alias("_kind"), version.alias("_v")
    )
    both = left.unionByName(right, allowMissingColumns=True)
    limit = {} if hot_rows is None else {"min_rows": hot_rows}
    places = events.select(*keys, F.col(ts).alias("_at")).unionByName(
        history.select(*keys, F.col(START).alias("_at"))
    )
    hot = hot_keys(places, keys, "_at", **limit)
    both = with_slice(both, keys, "_at", hot)

    upto = (Window.unboundedPreceding, Window.currentRow)
    part = keys if hot is None else [*keys, SLICE]
    order = ["_at", "_kind", *_version_order(columns, "_v")]
    in_order = Window.partitionBy(*part).orderBy(*order).rowsBetween(*upto)
    found = F.last("_v", ignorenulls=True).over(in_order)
    merged = both.withColumn("_found", found).where("_kind = 1")
    if hot is not None:
        before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        ends = [F.col(f"_v.{END}").isNull(), F.col(f"_v.{END}"), *[F.col(f"_v.{c}") for c in columns]]
        last = F.struct("_at", *[e.alias(f"e{i}") for i, e in enumerate(ends)])
        # one row per slice of a hot key
        lasts = (
            hot.only(both)
            .groupBy(*keys, SLICE)
            .agg(F.max_by("_v", F.when(F.col("_kind") == 0, last)).alias("_last"))
            .select(*keys, SLICE, F.last("_last", ignorenulls=True).over(before).alias("_earlier"))
        )
        merged = hot.attach(merged, lasts).withColumn("_found", F.coalesce("_found", "_earlier"))
    valid = F.col("_found")[END].isNull() | (F.col("_at") < F.col("_found")[END])
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    return merged.select(
        "_e.*", *[F.when(valid, F.col("_found")[c]).alias(c) for c in columns]
    )
