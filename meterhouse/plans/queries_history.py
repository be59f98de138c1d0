"""Queries over change history: snapshots, change feeds, as-of lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterhouse.operators import asof, history, marts, quality
from meterhouse.plans.fixtures import Tables
from meterhouse.plans.oracles import using
from meterhouse.plans.queries_events import change_rows, plan_history
from meterhouse.plans.registry import query
from meterhouse.session import write_and_read

START, END = history.START, history.END


def flat_changes(t: Tables) -> DataFrame:
    """``user_changes`` as flattened change rows."""
    return t.user_changes().select(
        "user_id",
        "plan_id",
        "remaining_budget",
        F.col("op").alias("_op"),
        F.unix_millis("changed_at").alias("_ts_ms"),
        F.col("part").alias("_part"),
        F.col("offset_").alias("_offset"),
    )


def log_history(t: Tables) -> DataFrame:
    return history.scd2_from_changes(flat_changes(t), ["user_id"])


def snapshot_history(t: Tables) -> DataFrame:
    return history.scd2_from_snapshots(t.user_snapshots(), ["user_id"], "snap_year")


def two_snapshots(t: Tables) -> tuple[DataFrame, DataFrame]:
    snaps = t.user_snapshots()
    return tuple(snaps.where(F.col("snap_year") == y).drop("snap_year") for y in (1997, 1998))


DIFF_SQL = using(
    ["user_snapshots"],
    """select coalesce(a.user_id, b.user_id) as user_id,
         case when a.user_id is null then 'insert' when b.user_id is null then 'delete'
              else 'update' end as change,
         a.status as before_status, b.status as after_status
       from (select * from user_snapshots where snap_year = 1997) a
       full join (select * from user_snapshots where snap_year = 1998) b on a.user_id = b.user_id
       where a.status is distinct from b.status""",
)


@query("cdc1_snapshot_diff", DIFF_SQL)
def _(t: Tables) -> DataFrame:
    prev, cur = two_snapshots(t)
    return history.snapshot_diff(prev, cur, ["user_id"]).select(
        "user_id",
        "change",
        F.col("before.status").alias("before_status"),
        F.col("after.status").alias("after_status"),
    )


@query(
    "cdc2_scd2_from_snapshots",
    using(
        ["snapshot_history"],
        """select user_id, status, start_year as __START_AT, end_year as __END_AT
           from snapshot_history""",
    ),
)
def scd2_snapshots(t: Tables) -> DataFrame:
    return snapshot_history(t)


@query(
    "cdc2_scd2_incremental",
    using(
        ["snapshot_history"],
        """select user_id, status, make_timestamp(start_year, 1, 1, 0, 0, 0) as __START_AT,
             make_timestamp(end_year, 1, 1, 0, 0, 0) as __END_AT from snapshot_history""",
    ),
)
def _(t: Tables) -> DataFrame:
    """The same history, built one snapshot after another."""
    from meterhouse.session import work_folder
    from meterhouse.streaming.history import SnapshotHistory

    snaps = t.user_snapshots()
    first, last = snaps.agg(F.min("snap_year"), F.max("snap_year")).first()
    store = SnapshotHistory(work_folder(t.spark, "snapshot-history"), ["user_id"])
    for n, year in enumerate(range(first, last + 1)):
        at = F.lit(f"{year}-01-01").cast("timestamp")
        store.apply(snaps.where(F.col("snap_year") == year).drop("snap_year"), at, n)
    return store.history(t.spark, last - first)


@query(
    "cdc3_untracked_columns",
    using(
        ["snapshot_history"],
        """select user_id, status,
             make_timestamp(coalesce(end_year, (select max(snap_year) + 1 from user_snapshots)) - 1,
                            1, 1, 0, 0, 0) as _snapshot_at,
             start_year as __START_AT, end_year as __END_AT from snapshot_history""",
    ),
)
def _(t: Tables) -> DataFrame:
    """The snapshot time differs in every row, yet opens no version."""
    snaps = t.user_snapshots().withColumn(
        "_snapshot_at", F.make_timestamp("snap_year", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    )
    return history.scd2_from_snapshots(
        snaps, ["user_id"], "snap_year", track_except=["_snapshot_at"]
    )


@query(
    "cdc4_scd1_from_snapshots",
    using(
        ["user_snapshots"],
        """select user_id, status from user_snapshots
           where snap_year = (select max(snap_year) from user_snapshots)""",
    ),
)
def _(t: Tables) -> DataFrame:
    return history.scd1_from_snapshots(t.user_snapshots(), "snap_year")


@query(
    "cdc5_scd2_from_changes",
    using(
        ["log_history"],
        """select user_id, plan_id, remaining_budget, start_ms as __START_AT, end_ms as __END_AT
           from log_history""",
    ),
)
def scd2_changes(t: Tables) -> DataFrame:
    return log_history(t)


@query(
    "cdc5_scd2_from_messages",
    using(
        ["log_history"],
        """select user_id, plan_id, remaining_budget, start_ms as __START_AT, end_ms as __END_AT
           from log_history""",
    ),
)
def _(t: Tables) -> DataFrame:
    """The same history out of raw messages; hot keys are looked for before they are parsed."""
    counted = flat_changes(t).select("user_id", "_ts_ms")
    return history.scd2_from_changes(change_rows(t), ["user_id"], count_on=counted)


@query(
    "cdc5_scd2_collapsed",
    using(
        ["user_changes"],
        """select user_id, plan_id, epoch_ms(changed_at) as __START_AT,
             epoch_ms(next_at) as __END_AT
           from (
             select *, lead(changed_at) over (partition by user_id order by changed_at) as next_at
             from (
               select *, lag(state) over (partition by user_id order by changed_at) as prev
               from (select *, case when op = 'd' then -1 else plan_id end as state
                     from (select *, row_number() over (partition by user_id, changed_at
                                                        order by offset_ desc) as rn
                           from user_changes) a where rn = 1) b) c
             where prev is distinct from state) d
           where state <> -1""",
    ),
)
def _(t: Tables) -> DataFrame:
    """Updates that leave the plan as it was open no version."""
    changes = flat_changes(t).drop("remaining_budget")
    return history.scd2_from_changes(changes, ["user_id"], collapse_unchanged=True)


@query(
    "cdc6_scd1_from_changes",
    using(
        ["user_changes"],
        """select user_id, plan_id, remaining_budget from (
             select *, row_number() over (partition by user_id
                                          order by changed_at desc, offset_ desc) as rn
             from user_changes) a where rn = 1 and op <> 'd'""",
    ),
)
def _(t: Tables) -> DataFrame:
    return history.scd1_from_changes(flat_changes(t), ["user_id"])


def status_history(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The order status of each customer, from yearly snapshots and from every order."""
    snaps = snapshot_history(t).withColumns(
        {
            c: F.make_timestamp(F.col(c), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
            for c in (START, END)
        }
    )
    changes = t.raw("orders").select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("o_orderstatus").alias("status"),
        F.lit("u").alias("_op"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("_ts_ms"),
        F.col("o_orderkey").alias("_offset"),
    )
    return snaps, history.scd2_from_changes(changes, ["user_id"])


LOG_STATUS_SQL = """
  select cast(o_custkey as int) as user_id, o_orderstatus as status, o_orderdate as start_at,
    lead(o_orderdate) over (partition by o_custkey order by o_orderdate) as end_at
  from (select *, row_number() over (partition by o_custkey, o_orderdate
                                     order by o_orderkey desc) as rn from orders) a
  where rn = 1"""


@query(
    "cdc7_compare_lanes",
    using(
        ["snapshot_history"],
        f"""select 'snapshot' as lane, user_id, status,
             make_timestamp(start_year, 1, 1, 0, 0, 0) as __START_AT,
             make_timestamp(end_year, 1, 1, 0, 0, 0) as __END_AT from snapshot_history
           union all
           select 'log', user_id, status, start_at, end_at from ({LOG_STATUS_SQL}) x""",
    ),
)
def _(t: Tables) -> DataFrame:
    snaps, log = status_history(t)
    return history.compare_lanes(snaps, log, ["user_id", "status"])


@query(
    "prj8_millis_validity",
    using(
        ["log_history"],
        """select user_id, plan_id, remaining_budget,
             make_timestamp(start_ms * 1000) as __START_AT,
             make_timestamp(end_ms * 1000) as __END_AT from log_history""",
    ),
)
def _(t: Tables) -> DataFrame:
    return history.millis_to_time(log_history(t))


@query(
    "cdc8_op_counts",
    using(
        ["user_changes"],
        """select 'meter.users' as topic,
             case when op = 'd' then 'delete' when n > 1 then 'update'
                  when offset_ % 2 = 1 then 'read' else 'create' end as operation,
             count(*) as changes
           from (select *, row_number() over (partition by user_id order by changed_at, offset_)
                   as n from user_changes) a
           group by 1, 2""",
    ),
)
def _(t: Tables) -> DataFrame:
    """The first change of a key counts as its creation, or on odd offsets as an initial read."""
    changes = flat_changes(t)
    first = changes.groupBy("user_id").agg(
        F.min(F.struct("_ts_ms", "_offset"))["_offset"].alias("_first")
    )
    opening = (F.col("_offset") == F.col("_first")) & (F.col("_op") != "d")
    relabelled = changes.join(first, "user_id").withColumn(
        "_op",
        F.when(opening & (F.col("_offset") % 2 == 1), "r").when(opening, "c").otherwise(F.col("_op")),
    )
    return history.op_counts(relabelled, F.lit("meter.users"))


@query(
    "cdc9_scd2_current",
    using(
        ["log_history"],
        "select user_id, plan_id, remaining_budget from log_history where end_ms is null",
    ),
)
def _(t: Tables) -> DataFrame:
    return history.scd2_current(log_history(t)).drop(START, END)


@query(
    "cdc9_scd2_as_of",
    using(
        ["log_history"],
        """select user_id, plan_id, remaining_budget from log_history
           where start_ms <= epoch_ms(timestamp '1998-07-01')
             and (end_ms is null or end_ms > epoch_ms(timestamp '1998-07-01'))""",
    ),
)
def _(t: Tables) -> DataFrame:
    at = F.unix_millis(F.lit("1998-07-01").cast("timestamp"))
    return history.scd2_as_of(log_history(t), at).drop(START, END)


@query(
    "cdc10_lost_versions",
    using(
        ["user_snapshots"],
        """select distinct cast(o_custkey as int) as user_id, o_orderstatus as status from (
             select *, row_number() over (partition by o_custkey, o_orderdate
                                          order by o_orderkey desc) as rn from orders) a
           where rn = 1 and not exists (select 1 from user_snapshots s
             where s.user_id = a.o_custkey and s.status = a.o_orderstatus)""",
    ),
)
def _(t: Tables) -> DataFrame:
    snaps, log = status_history(t)
    return history.lost_versions(log, snaps, ["user_id"], ["status"])


# --- joins -----------------------------------------------------------------------------------


@query(
    "join1_user_limits",
    using(
        ["users", "usage", "plans"],
        """select u.user_id, u.plan_id, u.remaining_budget, g.hourly_token, g.daily_token,
             g.monthly_token, p.hourly_token_limit, p.daily_token_limit, p.monthly_token_limit
           from users u join usage g on g.user_id = u.user_id
           join plans p on p.plan_id = u.plan_id""",
    ),
)
def _(t: Tables) -> DataFrame:
    return (
        t.users()
        .select("user_id", "plan_id", "remaining_budget")
        .join(t.usage().select("user_id", "hourly_token", "daily_token", "monthly_token"), "user_id")
        .join(
            t.plans().select(
                "plan_id", "hourly_token_limit", "daily_token_limit", "monthly_token_limit"
            ),
            "plan_id",
        )
    )


@query(
    "join2_limit_as_of",
    using(
        ["gate_requests", "users", "plan_history"],
        """select r.request_seq, u.plan_id, r.ts, r.tokens, h.hourly_token_limit,
             r.tokens > h.hourly_token_limit as over_limit
           from gate_requests r join users u on u.user_id = r.user_id
           left join plan_history h on h.plan_id = u.plan_id and h.start_at <= r.ts
             and (h.end_at is null or r.ts < h.end_at)""",
    ),
)
def limit_as_of(t: Tables) -> DataFrame:
    requests = t.gate_requests().join(t.users().select("user_id", "plan_id"), "user_id")
    rows = asof.as_of_join(requests, plan_history(t), ["plan_id"], "ts", ["hourly_token_limit"])
    return rows.select(
        "request_seq",
        "plan_id",
        "ts",
        "tokens",
        "hourly_token_limit",
        (F.col("tokens") > F.col("hourly_token_limit")).alias("over_limit"),
    )


@query(
    "join2_budget_as_of",
    using(
        ["log_history"],
        """select o.o_orderkey as order_id, cast(o.o_custkey as int) as user_id,
             h.remaining_budget
           from orders o left join log_history h on h.user_id = o.o_custkey
             and h.start_ms <= epoch_ms(o.o_orderdate) - 86400000
             and (h.end_ms is null or epoch_ms(o.o_orderdate) - 86400000 < h.end_ms)""",
    ),
)
def _(t: Tables) -> DataFrame:
    """The budget each customer had a day before an order: a history too large to broadcast."""
    orders = t.raw("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").cast("int").alias("user_id"),
        (F.unix_millis(F.col("o_orderdate").cast("timestamp")) - 86_400_000).alias("day_before"),
    )
    stored = write_and_read(log_history(t), "budgets")
    return asof.as_of_join(
        orders, stored, ["user_id"], "day_before", ["remaining_budget"]
    ).drop("day_before")


@query(
    "join3_snapshot_diff_counts",
    f"select change, count(*) as changes from ({DIFF_SQL}) d group by change",
)
def _(t: Tables) -> DataFrame:
    prev, cur = two_snapshots(t)
    return (
        history.snapshot_diff(prev, cur, ["user_id"])
        .groupBy("change")
        .agg(F.count("*").alias("changes"))
    )


@query(
    "join4_broken_references",
    """select s_suppkey, s_nationkey % 8 as plan_id from supplier
       where s_nationkey % 8 not in (select r_regionkey from region)""",
)
def _(t: Tables) -> DataFrame:
    children = t.raw("supplier").select(
        "s_suppkey", (F.col("s_nationkey") % 8).alias("plan_id")
    )
    return quality.broken_reference(children, "plan_id", t.plans(), "plan_id")


# --- budget mart -----------------------------------------------------------------------------


@query(
    "agg5_budget_burndown",
    using(
        ["log_history"],
        """select user_id, start_ms as __START_AT, remaining_budget, spent,
             cast(sum(spent) over (partition by user_id order by start_ms) as bigint)
               as spent_so_far,
             round(100.0::double * remaining_budget / 600000, 4) as share_left_pct
           from (select *, cast(greatest(coalesce(lag(remaining_budget) over
                     (partition by user_id order by start_ms) - remaining_budget, 0), 0) as int)
                     as spent from log_history) a""",
    ),
)
def _(t: Tables) -> DataFrame:
    budgets = log_history(t).withColumn("token_budget", F.lit(600_000))
    counted = flat_changes(t).select("user_id", F.col("_ts_ms").alias(START))
    return marts.budget_burndown(budgets, ["user_id"], count_on=counted)
