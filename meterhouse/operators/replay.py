"""Gate replay: refresh, admit and record every user's requests in event order.

Each decision depends on the one before it through three anchored counters and a budget, which no
window expression can carry; the requests of one user form a chain, users are independent. Spark
brings each user's requests together in order, and a scan walks over them holding one user's seven
numbers. A user with more requests than one task should own is cut into ordered pieces, balanced by
row count, and the numbers are carried from piece to piece.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterhouse.functions.columns import MICROS_PER_HOUR
from meterhouse.operators import gate
from meterhouse.operators.gate import WINDOWS
from meterhouse.session import write_and_read

LONG_ROWS = 5_000_000  # requests of one user, above which they are cut into pieces
TASK_ROWS = 5_000_000  # requests one task scans on a large input
SMALL_TASK_ROWS = 10_000  # below this a task costs more to start than to run

STATE = [*[f"{w}_token" for w in WINDOWS], *[f"{w}_start" for w in WINDOWS], "remaining_budget"]
LIMITS = [*[f"{w}_token_limit" for w in WINDOWS], "token_budget", "usable", "plan_id"]
START = [f"from_{c}" for c in STATE]  # the state a scan begins with
REQUEST = ["user_id", "ts_us", "request_seq", "tokens", "allow_budget"]

LINE_SCHEMA = (
    "user_id int, request_seq bigint, ts_us bigint, tokens bigint, plan_id int, "
    "validate_msg string, record_msg string, charged bigint, hourly_token bigint, "
    "daily_token bigint, monthly_token bigint, hourly_start bigint, daily_start bigint, "
    "monthly_start bigint, remaining_budget bigint"
)
LINE_ARROW = pa.schema(
    [
        (name, {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[kind])
        for name, kind in (part.split() for part in LINE_SCHEMA.split(", "))
    ]
)
PASSED_ON = LINE_ARROW.names[:5]  # columns a scan hands through as they are
DECIDED = LINE_ARROW.names[5:]
HOUR, DAY, MONTH = (hours * MICROS_PER_HOUR for hours in WINDOWS.values())
# messages by the set of windows at their limit, as bits in the order of WINDOWS
HITS = [" ".join(w.upper() for i, w in enumerate(WINDOWS) if bits >> i & 1) for bits in range(8)]


class Meter:
    """Counters, window starts and budget of one user, and the limits they are held against."""

    __slots__ = ("state", "limits", "total", "usable")

    def __init__(self, state: list, limits: list):
        self.state = tuple(state)
        self.limits, self.total, self.usable = tuple(limits[:3]), limits[3], limits[4]

    def run(self, times: list, amounts: list, allows: list, forget: bool) -> list[tuple]:
        """Requests of the user in order; one tuple of the ``DECIDED`` columns for each.

        ``forget`` undoes the refresh of a request that admission refuses. Where no request can pass
        before the next window ends, the stretch up to it is answered in one go.
        """
        h, d, m, hs, ds, ms, budget = self.state
        lh, ld, lm = self.limits
        floor, usable = self.total * gate.BUDGET_FLOOR_PERCENT, self.usable
        out: list[tuple] = []
        i, n = 0, len(times)
        while i < n:
            ts, tokens, allow = times[i], amounts[i], allows[i]
            old = (h, d, m, hs, ds, ms)
            if ts - hs >= HOUR:
                h, hs = 0, ts
            if ts - ds >= DAY:
                d, ds = 0, ts
            if ts - ms >= MONTH:
                m, ms = 0, ts
            hit = (h >= lh) + 2 * (d >= ld) + 4 * (m >= lm)
            rich = usable and budget * 100 >= floor
            if hit and not (allow and rich):
                stop = i + 1
                fresh = (h, d, m, hs, ds, ms) != old
                if forget and fresh:
                    h, d, m, hs, ds, ms = old
                elif not rich:
                    stop = bisect_left(times, min(hs + HOUR, ds + DAY, ms + MONTH), stop, n)
                state = (h, d, m, hs, ds, ms, budget)
                plain = (HITS[hit] + gate.LIMIT_EXCEEDED, None, 0, *state)
                poor = (HITS[hit] + gate.NO_BUDGET_SUFFIX, None, 0, *state)
                out.extend([poor if a else plain for a in allows[i:stop]])
                i = stop
                continue
            over_h, over_d, over_m = h + tokens - lh, d + tokens - ld, m + tokens - lm
            need = max(over_h, over_d, over_m, 0)
            if not need:
                message = gate.SUCCESS
            elif not allow:
                message = gate.PLAN_LIMIT_EXCEEDED
            elif budget > need:
                message = gate.SUCCESS_USING_OVERFLOW
            else:
                message = gate.CHECK_VIOLATION if budget == need else gate.INSUFFICIENT_BUDGET
            charged = 0
            if message in gate.CHARGED:
                h = lh if over_h > 0 else h + tokens
                d = ld if over_d > 0 else d + tokens
                m = lm if over_m > 0 else m + tokens
                charged = need
                budget -= need
            admitted = gate.ALLOWED_USING_BUDGET if hit else gate.ALLOWED
            out.append((admitted, message, charged, h, d, m, hs, ds, ms, budget))
            i += 1
        self.state = (h, d, m, hs, ds, ms, budget)
        return out


def new_meter(first_us: int, start: list, limits: list) -> Meter:
    """A meter at the given state; windows without a start begin with the first request."""
    return Meter([*start[:3], *[first_us if s is None else s for s in start[3:6]], start[6]], limits)


def scan(mode: str):
    """Walks over batches sorted by user and time; holds one meter and one batch at a time."""
    forget = mode == "api"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, meter = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            users = batch.column("user_id").to_numpy()
            times, amounts = (batch.column(c).to_numpy().tolist() for c in ("ts_us", "tokens"))
            allows = batch.column("allow_budget").to_pylist()
            bounds = [0, *(np.flatnonzero(users[1:] != users[:-1]) + 1).tolist(), len(users)]
            out: list[tuple] = []
            for lo, hi in zip(bounds, bounds[1:]):
                if meter is None or users[lo] != current:
                    current = users[lo]
                    start, limits = (
                        [batch.column(c)[lo].as_py() for c in names] for names in (START, LIMITS)
                    )
                    meter = new_meter(times[lo], start, limits)
                out.extend(meter.run(times[lo:hi], amounts[lo:hi], allows[lo:hi], forget))
            fields = [LINE_ARROW.field(c) for c in DECIDED]
            decided = [pa.array(c, f.type) for c, f in zip(zip(*out), fields)]
            kept = [batch.column(c) for c in PASSED_ON]
            yield pa.RecordBatch.from_arrays([*kept, *decided], schema=LINE_ARROW)

    return run


def start_state() -> list[Column]:
    """Given counters where there are some, else zero from the first request on."""
    counts = [F.coalesce(f"{w}_token", F.lit(0)).cast("bigint") for w in WINDOWS]
    starts = [F.unix_micros(f"{w}_session_start") for w in WINDOWS]
    values = [*counts, *starts, F.col("remaining_budget")]
    return [value.alias(name) for value, name in zip(values, START)]


def user_limits(
    users: DataFrame, plans: DataFrame, usage: DataFrame | None = None, honour_active: bool = True
) -> DataFrame:
    """Per user: plan, limits, budget, whether the budget may be used, and the start state."""
    limits = [F.col(f"{w}_token_limit").cast("bigint").alias(f"{w}_token_limit") for w in WINDOWS]
    rows = users.join(plans.select("plan_id", *limits), "plan_id").withColumns(
        {
            "token_budget": F.col("token_budget").cast("bigint"),
            "remaining_budget": F.col("remaining_budget").cast("bigint"),
            "usable": F.col("is_active") if honour_active else F.lit(True),
        }
    )
    if usage is None:
        rows = rows.withColumns(
            {f"{w}_token": F.lit(None).cast("int") for w in WINDOWS}
            | {f"{w}_session_start": F.lit(None).cast("timestamp") for w in WINDOWS}
        )
    else:
        rows = rows.join(usage, "user_id", "left")
    return rows.select("user_id", *LIMITS, *start_state())


def compact(requests: DataFrame) -> DataFrame:
    """The five request columns the gate needs; no token count means no tokens."""
    return requests.select(
        "user_id",
        F.unix_micros("ts").alias("ts_us"),
        F.col("request_seq").cast("bigint").alias("request_seq"),
        F.coalesce(F.col("tokens").cast("bigint"), F.lit(0)).alias("tokens"),
        F.coalesce("allow_budget", F.lit(False)).alias("allow_budget"),
    )


def _tasks(df: DataFrame, rows: int) -> int:
    small = min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // SMALL_TASK_ROWS))
    return max(1, small, -(-rows // TASK_ROWS))


def _scan_users(requests: DataFrame, state: DataFrame, mode: str, tasks: int) -> DataFrame:
    """One shuffle of the bare requests by user; the state joins on the same partitioning.

    The hint keeps the join on that partitioning, which the scan relies on: a broadcast of either
    side would not. The state is one row per user, so its share of a partition is small.
    """
    return (
        requests.repartition(tasks, "user_id")
        .join(state.hint("shuffle_hash"), "user_id")
        .sortWithinPartitions("user_id", "ts_us", "request_seq")
        .mapInArrow(scan(mode), LINE_SCHEMA)
    )


def _scan_pieces(
    requests: DataFrame, state: DataFrame, mode: str, rows: int, piece_rows: int
) -> DataFrame:
    """Long histories: ordered pieces, replayed round by round with the state carried.

    Range partitioning on (user, time) balances the pieces by row count, whoever owns the rows.
    Round ``r`` runs piece ``r`` of every long user at once. The cut is written down first, since a
    range partitioning is sampled and may fall elsewhere when it is computed again.
    """
    n = max(1, -(-rows // piece_rows))
    cut = write_and_read(
        requests.repartitionByRange(n, "user_id", "ts_us", "request_seq").withColumn(
            "_part", F.spark_partition_id()
        ),
        "replay-cut",
    )
    place = Window.partitionBy("user_id").orderBy("_part")
    # one row per user and partition the user reaches into
    pieces = (
        cut.select("user_id", "_part").distinct().withColumn("_piece", F.row_number().over(place))
    )
    placed = cut.join(pieces, ["user_id", "_part"]).drop("_part")
    path = write_and_read(placed, "replay-pieces", ["_piece"])  # a round reads its own piece only
    per_round = path.groupBy("_piece").agg(F.count("*").alias("n")).orderBy("_piece").collect()

    state = state.join(pieces.select("user_id").distinct(), "user_id", "left_semi")
    done: DataFrame | None = None
    for r, size in per_round:
        work = path.where(F.col("_piece") == r).drop("_piece")
        out = write_and_read(
            _scan_users(work, state, mode, _tasks(work, size)), f"replay-round-{r}"
        )
        done = out if done is None else done.unionByName(out)
        if r < len(per_round):
            last = out.groupBy("user_id").agg(
                F.max_by(F.struct(*STATE), F.struct("ts_us", "request_seq")).alias("_s")
            )
            carried = [F.col("_s")[c].alias(name) for c, name in zip(STATE, START)]
            state = write_and_read(
                state.select("user_id", *LIMITS).join(last, "user_id").select("user_id", *LIMITS, *carried),
                f"replay-state-{r}",
            )
    return done


def replay_gate(
    requests: DataFrame,
    users: DataFrame,
    plans: DataFrame,
    usage: DataFrame | None = None,
    mode: str = "procedure",
    honour_active: bool = True,
    long_rows: int = LONG_ROWS,
    piece_rows: int = TASK_ROWS,
) -> DataFrame:
    """One outcome row per request of every known user.

    ``requests``: request_seq, user_id, ts, tokens, allow_budget. ``usage`` gives start counters;
    without it a user starts at zero with the first request. In ``procedure`` mode every refresh is
    kept; ``api`` mode forgets the refresh of a request that admission refuses, as a caller that
    rolls back would. ``honour_active`` denies inactive users the use of their budget.
    """
    state = user_limits(users, plans, usage, honour_active)
    return outcomes_of(replay_lines(compact(requests), state, mode, long_rows, piece_rows))


def replay_lines(
    rows: DataFrame,
    state: DataFrame,
    mode: str = "procedure",
    long_rows: int = LONG_ROWS,
    piece_rows: int = TASK_ROWS,
) -> DataFrame:
    """Compact requests of the users in ``state`` (see ``user_limits``), each with the state it left."""
    sizes = rows.groupBy("user_id").agg(F.count("*").alias("_n"))
    is_long = F.col("_n") > long_rows
    total = sizes.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(is_long, F.col("_n"))), F.lit(0)).alias("long_rows"),
    ).first()
    if not total["long_rows"]:
        lines = _scan_users(rows, state, mode, _tasks(rows, total["rows"]))
    else:
        long = write_and_read(sizes.where(is_long).select("user_id"), "replay-long-users")
        lines = _scan_pieces(
            rows.join(long, "user_id", "left_semi"), state, mode, total["long_rows"], piece_rows
        )
        rest = total["rows"] - total["long_rows"]
        if rest:
            short = rows.join(long, "user_id", "left_anti")
            lines = lines.unionByName(_scan_users(short, state, mode, _tasks(rows, rest)))
    return lines


def outcomes_of(lines: DataFrame) -> DataFrame:
    """The outcome rows of replayed lines."""
    return lines.select(
        "request_seq",
        "user_id",
        "plan_id",
        F.timestamp_micros("ts_us").alias("ts"),
        "tokens",
        "validate_msg",
        "record_msg",
        F.coalesce("record_msg", "validate_msg").alias("outcome"),
        "charged",
        *[f"{w}_token" for w in WINDOWS],
        "remaining_budget",
    )


def final_state(outcomes: DataFrame) -> DataFrame:
    """Counters and budget of each user after the last request; map tasks keep one row per user."""
    newest = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("request_seq"))
    return (
        outcomes.withColumn("_rank", F.row_number().over(newest))
        .where("_rank = 1")
        .select("user_id", "plan_id", *[f"{w}_token" for w in WINDOWS], "remaining_budget")
    )


def log_rows(outcomes: DataFrame, mode: str = "procedure") -> DataFrame:
    """The query log the replayed requests leave behind.

    A charged request is logged bare by the gate and in full by its caller; a request refused at
    recording leaves one full failed row; one refused at admission leaves one bare row with no
    tokens, which ``api`` mode rolls back.
    """
    passed = F.col("record_msg").isNotNull()
    charged = F.coalesce(F.col("record_msg").isin(gate.CHARGED), F.lit(False))

    def row(status: Column, tokens: Column, full: bool) -> Column:
        return F.struct(
            status.alias("query_status"),
            tokens.cast("bigint").alias("tokens_used"),
            F.lit(full).alias("is_full"),
        )

    bare = row(F.lit("success"), F.col("tokens"), False)
    full = row(F.when(charged, "success").otherwise("failed"), F.col("tokens"), True)
    lines = [F.when(charged, bare), F.when(passed, full)]
    if mode == "procedure":
        lines.append(F.when(~passed, row(F.lit("failed"), F.lit(0), False)))
    return outcomes.select(
        "request_seq",
        "user_id",
        "plan_id",
        F.col("ts").alias("time_stamp"),
        F.inline(F.array_compact(F.array(*lines))),
    )
