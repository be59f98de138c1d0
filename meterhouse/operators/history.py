"""Change history: snapshot diffs, SCD1 and SCD2 from snapshots and from change feeds.

Validity intervals are half-open, ``[__START_AT, __END_AT)``; an open version has a NULL end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterhouse.functions.columns import op_name
from meterhouse.operators.skew import hot_keys, neighbour, with_slice

START, END = "__START_AT", "__END_AT"


def _tracked(df: DataFrame, skip: list[str], tracked: list[str] | None, track_except: list[str]):
    if tracked is not None:
        return tracked
    return [c for c in df.columns if c not in skip and c not in track_except]


def snapshot_diff(
    prev: DataFrame, cur: DataFrame, keys: list[str], tracked: list[str] | None = None
) -> DataFrame:
    """Inserted, updated and deleted keys between two snapshots, with both row images.

    NULLs compare as equal to NULLs. One shuffle per side, none where both are bucketed by key.
    """
    tracked = _tracked(cur, keys, tracked, [])
    before = prev.select(*keys, F.struct(*tracked).alias("before"))
    after = cur.select(*keys, F.struct(*tracked).alias("after"))
    change = (
        F.when(F.col("before").isNull(), "insert")
        .when(F.col("after").isNull(), "delete")
        .when(~F.col("before").eqNullSafe(F.col("after")), "update")
    )
    return (
        before.join(after, keys, "full_outer")
        .withColumn("change", change)
        .where(F.col("change").isNotNull())
        .select(*keys, "change", "before", "after")
    )


def scd2_from_snapshots(
    snaps: DataFrame,
    keys: list[str],
    version: str,
    tracked: list[str] | None = None,
    track_except: list[str] | None = None,
) -> DataFrame:
    """Full history from a table that stacks all snapshots, tagged by ``version``.

    A version opens when a key appears or a tracked column changes, and closes at the next snapshot
    that changes or lacks the key. Untracked columns take the newest value of their version. A key
    has one row per snapshot, so no key can outgrow the number of snapshots.
    """
    track_except = track_except or []
    tracked = _tracked(snaps, [*keys, version], tracked, track_except)
    carried = [c for c in snaps.columns if c not in keys and c != version]

    # one row per snapshot taken, so small enough for one task and for a broadcast: its place in
    # the sequence and its successor
    order = Window.orderBy(version)
    calendar = (
        snaps.select(version)
        .distinct()
        .select(
            version,
            F.row_number().over(order).alias("_no"),
            F.lead(version).over(order).alias("_next"),
        )
    )
    per_key = Window.partitionBy(*keys).orderBy("_no")
    state = F.struct("_no", F.struct(*tracked).alias("_s"))
    rows = (
        snaps.join(F.broadcast(calendar), version)
        .withColumns({"_before": F.lag(state).over(per_key), "_after": F.lead(state).over(per_key)})
    )

    def continues(neighbour: str, step: int) -> Column:
        other = F.col(neighbour)
        same = (other["_no"] == F.col("_no") + step) & other["_s"].eqNullSafe(F.struct(*tracked))
        return F.coalesce(same, F.lit(False))

    # of every version only its first and last row go on, often one and the same
    rows = (
        rows.withColumn("_opens", ~continues("_before", -1))
        .withColumn("_closes", ~continues("_after", 1))
        .where("_opens or _closes")
    )
    newest = F.struct("_next", *carried)
    rows = rows.withColumn(
        "_last", F.when(F.col("_closes"), newest).otherwise(F.lead(newest).over(per_key))
    )
    return rows.where("_opens").select(
        *keys,
        *[F.col("_last")[c].alias(c) for c in carried],
        F.col(version).alias(START),
        F.col("_last._next").alias(END),
    )


def scd2_apply_snapshot(
    current: DataFrame,
    snap: DataFrame,
    keys: list[str],
    at: Column,
    tracked: list[str] | None = None,
    track_except: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One more snapshot against the open versions: (new open versions, versions just closed).

    Closed history is append-only and never read again, so a run costs as much as the dimension,
    not as its history.
    """
    track_except = track_except or []
    tracked = _tracked(snap, keys, tracked, track_except)
    carried = [c for c in snap.columns if c not in keys]
    old = current.select(*keys, F.struct(*carried, START).alias("_old"))
    new = snap.select(*keys, F.struct(*carried).alias("_new"))
    both = old.join(new, keys, "full_outer")
    same = F.struct(*[F.col("_old")[c] for c in tracked]).eqNullSafe(
        F.struct(*[F.col("_new")[c] for c in tracked])
    )
    kept = F.col("_old").isNotNull() & F.col("_new").isNotNull() & same
    opened = (
        both.where(F.col("_new").isNotNull())
        .select(
            *keys,
            *[F.col("_new")[c].alias(c) for c in carried],
            F.when(kept, F.col("_old")[START]).otherwise(at).alias(START),
        )
        .withColumn(END, F.lit(None).cast(current.schema[START].dataType))
    )
    closed = both.where(F.col("_old").isNotNull() & ~kept).select(
        *keys,
        *[F.col("_old")[c].alias(c) for c in carried],
        F.col("_old")[START].alias(START),
        at.cast(current.schema[START].dataType).alias(END),
    )
    return opened, closed


def scd1_from_snapshots(snaps: DataFrame, version: str) -> DataFrame:
    """Rows of the newest snapshot; keys it lacks are gone."""
    newest = snaps.agg(F.max(version)).scalar()
    return snaps.where(F.col(version) == newest).drop(version)


def scd2_from_changes(
    changes: DataFrame,
    keys: list[str],
    seq: str = "_ts_ms",
    tie: list[str] | None = None,
    delete_expr: str = "_op = 'd'",
    except_cols: list[str] | None = None,
    collapse_unchanged: bool = False,
    hot_rows: int | None = None,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Full history from a change feed, in any arrival order.

    Changes of a key that share ``seq`` are ordered by ``tie`` and the last one counts. A delete
    closes the version before it and opens none. One shuffle on the key serves every step; keys with
    more than ``hot_rows`` changes are cut along ``seq`` (see ``operators.skew``). ``count_on`` is a
    cheaper frame with the same keys and ``seq`` to look for such keys in.
    """
    tie = tie if tie is not None else [c for c in ("_part", "_offset") if c in changes.columns]
    except_cols = except_cols if except_cols is not None else ["_op", "_ts_ms", "_part", "_offset"]
    carried = [c for c in changes.columns if c not in keys and c not in except_cols]

    limit = {} if hot_rows is None else {"min_rows": hot_rows}
    hot = hot_keys(changes if count_on is None else count_on, keys, seq, **limit)
    sliced = with_slice(changes, keys, seq, hot)

    nexts = neighbour(sliced, keys, [seq, *tie], F.col(seq), "_next", hot)
    # a row followed by an equal seq was overtaken within its tie
    last = nexts.where(F.col("_next").isNull() | (F.col("_next") > F.col(seq)))
    last = last.withColumn("_gone", F.coalesce(F.expr(delete_expr), F.lit(False)))

    if collapse_unchanged:
        # deletes stay in, as NULL states, so that equal rows around one do not join up
        state = F.when(~F.col("_gone"), F.struct(*carried))
        last = neighbour(last, keys, [seq], state, "_prev", hot, back=True)
        last = last.where(F.col("_gone") | ~state.eqNullSafe(F.col("_prev")))
        last = neighbour(last.drop("_next", "_prev"), keys, [seq], F.col(seq), "_next", hot)

    return last.where(~F.col("_gone")).select(
        *keys, *carried, F.col(seq).alias(START), F.col("_next").alias(END)
    )


def scd1_from_changes(
    changes: DataFrame,
    keys: list[str],
    seq: str = "_ts_ms",
    tie: list[str] | None = None,
    delete_expr: str = "_op = 'd'",
    except_cols: list[str] | None = None,
) -> DataFrame:
    """The last state of every key that is not deleted; map tasks keep one row per key."""
    tie = tie if tie is not None else [c for c in ("_part", "_offset") if c in changes.columns]
    except_cols = except_cols if except_cols is not None else ["_op", "_ts_ms", "_part", "_offset"]
    carried = [c for c in changes.columns if c not in keys and c not in except_cols]
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in [seq, *tie]])
    return (
        changes.withColumn("_rank", F.row_number().over(newest))
        .where("_rank = 1")
        .where(~F.coalesce(F.expr(delete_expr), F.lit(False)))
        .select(*keys, *carried)
    )


def scd2_current(history: DataFrame) -> DataFrame:
    return history.where(F.col(END).isNull())


def scd2_as_of(history: DataFrame, at: Column) -> DataFrame:
    """The versions valid at an instant."""
    return history.where((F.col(START) <= at) & (F.col(END).isNull() | (F.col(END) > at)))


def millis_to_time(history: DataFrame) -> DataFrame:
    """Validity columns in epoch milliseconds as timestamps."""
    return history.withColumns({c: F.timestamp_millis(F.col(c)) for c in (START, END)})


def compare_lanes(
    snapshot_history: DataFrame,
    log_history: DataFrame,
    columns: list[str],
    labels: tuple[str, str] = ("snapshot", "log"),
) -> DataFrame:
    """Both histories of the same table under one schema, told apart by ``lane``."""
    sides = []
    for label, side in zip(labels, (snapshot_history, log_history)):
        if dict(side.dtypes)[START] == "bigint":
            side = millis_to_time(side)
        sides.append(
            side.select(
                F.lit(label).alias("lane"),
                *columns,
                F.col(START).cast("timestamp").alias(START),
                F.col(END).cast("timestamp").alias(END),
            )
        )
    return sides[0].unionByName(sides[1])


def op_counts(changes: DataFrame, topic: Column) -> DataFrame:
    """Change messages per topic and operation, by name."""
    return (
        changes.select(topic.alias("topic"), op_name(F.col("_op")).alias("operation"))
        .groupBy("topic", "operation")
        .agg(F.count("*").alias("changes"))
    )


def lost_versions(
    log_history: DataFrame, snapshot_history: DataFrame, keys: list[str], values: list[str]
) -> DataFrame:
    """States the log saw and no snapshot did, one row per key and state."""
    on = [*keys, *values]
    seen = snapshot_history.select(*on).distinct()
    return log_history.select(*on).distinct().join(seen, on, "left_anti")
