"""Queries over quota decisions: admission, recording, replay, limits left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterhouse.operators import gate, marts, replay
from meterhouse.plans.fixtures import Tables
from meterhouse.plans.oracles import using
from meterhouse.plans.registry import query

NOW = "2024-01-30 12:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def _refreshed(window: str, hours: int) -> str:
    start = f"{window}_session_start"
    expired = f"epoch_us(timestamp '{NOW}') - epoch_us({start}) >= {hours}*3600000000"
    return (
        f"case when {expired} then 0 else {window}_token end as {window}_token, "
        f"case when {expired} then timestamp '{NOW}' else {start} end as {start}"
    )


REFRESH_SQL = (
    f"select user_id, {_refreshed('hourly', 1)}, {_refreshed('daily', 24)}, "
    f"{_refreshed('monthly', 672)} from usage"
)


@query("quo1_refresh_usage", using(["usage"], REFRESH_SQL))
def _(t: Tables) -> DataFrame:
    return gate.refresh_usage(t.usage(), now())


HIT_SQL = """concat_ws(' ', case when g.hourly_token >= l.hl then 'HOURLY' end,
  case when g.daily_token >= l.dl then 'DAILY' end,
  case when g.monthly_token >= l.ml then 'MONTHLY' end)"""


def _validate_sql(counters: str) -> str:
    return f"""
      select request_seq, user_id, ts, tokens, allow_budget, plan_id,
        case when hit = '' then 'ALLOWED'
             when not allow_budget then hit || '_LIMIT_EXCEEDED'
             when is_active and remaining_budget >= 0.02 * token_budget
               then 'ALLOWED_USING_BUDGET'
             else hit || '_LIMIT_EXCEEDED + INSUFFICIENT_BUDGET' end as validate_msg
      from (
        select r.*, case when l.is_active then l.plan_id end as plan_id, l.is_active,
          l.remaining_budget, l.token_budget, {HIT_SQL} as hit
        from gate_requests r left join limits l on l.user_id = r.user_id
        left join ({counters}) g on g.user_id = r.user_id) x"""


@query(
    "quo2_validate_requests",
    using(["gate_requests", "limits", "usage"], _validate_sql("select * from usage")),
)
def _(t: Tables) -> DataFrame:
    return gate.validate_requests(t.gate_requests(), t.users(), t.usage(), t.plans())


@query(
    "quo2_validate_refreshed",
    using(["gate_requests", "limits", "usage"], _validate_sql(REFRESH_SQL)),
)
def _(t: Tables) -> DataFrame:
    return gate.validate_requests(t.gate_requests(), t.users(), t.usage(), t.plans(), now=now())


@query(
    "quo2_validate_strict",
    using(
        ["gate_requests", "limits", "usage"],
        f"""select v.* replace (case when l.is_active then validate_msg else 'USER_NOT_ACTIVE' end
              as validate_msg)
            from ({_validate_sql("select * from usage")}) v join limits l on l.user_id = v.user_id""",
    ),
)
def _(t: Tables) -> DataFrame:
    return gate.validate_requests(
        t.gate_requests(), t.users(), t.usage(), t.plans(), mode="strict"
    )


RECORD_SQL = """
  select request_seq, user_id, ts, tokens, allow_budget, plan_id, record_msg,
    case when charged then need else 0 end as charged,
    case when charged then hourly_token + tokens - oh else hourly_token end as hourly_token,
    case when charged then daily_token + tokens - od else daily_token end as daily_token,
    case when charged then monthly_token + tokens - om else monthly_token end as monthly_token,
    case when charged then remaining_budget - need else remaining_budget end
      as remaining_budget
  from (
    select *, record_msg in ('SUCCESS', 'SUCCESS_USING_OVERFLOW') as charged from (
      select *, case when need = 0 then 'SUCCESS' when not allow_budget then 'PLAN_LIMIT_EXCEEDED'
                     when remaining_budget > need then 'SUCCESS_USING_OVERFLOW'
                     when remaining_budget = need then 'CHECK_VIOLATION'
                     else 'INSUFFICIENT_BUDGET' end as record_msg
      from (
        select *, greatest(oh, od, om) as need from (
          select r.*, l.plan_id, l.remaining_budget, g.hourly_token, g.daily_token,
            g.monthly_token,
            greatest(0, g.hourly_token + r.tokens - l.hl) as oh,
            greatest(0, g.daily_token + r.tokens - l.dl) as od,
            greatest(0, g.monthly_token + r.tokens - l.ml) as om
          from gate_requests r join limits l on l.user_id = r.user_id
          join usage g on g.user_id = r.user_id) a) b) c) d"""


@query("quo3_record_usage", using(["gate_requests", "limits", "usage"], RECORD_SQL))
def _(t: Tables) -> DataFrame:
    return gate.record_usage(t.gate_requests(), t.users(), t.usage(), t.plans())


@query(
    "quo4_remaining_limits",
    using(
        ["users", "usage", "limits"],
        """select u.user_id, u.user_name, u.remaining_budget, l.hl - g.hourly_token
             as hourly_remaining, l.dl - g.daily_token as daily_remaining,
             l.ml - g.monthly_token as monthly_remaining
           from users u join usage g on g.user_id = u.user_id
           join limits l on l.user_id = u.user_id where u.is_active""",
    ),
)
def _(t: Tables) -> DataFrame:
    return gate.remaining_limits(t.users(), t.usage(), t.plans())


def _gate_cte(mode: str) -> str:
    """The gate as a recursion over each user's requests, one step per request."""
    blocked = "not passed" if mode == "api" else "false"

    def kept(new: str, old: str) -> str:
        return f"case when {blocked} then {old} else {new} end"

    return f"""
      gate(user_id, n, h, hs, d, ds, m, ms, b, request_seq, plan_id, ts, tokens, validate_msg,
           record_msg, charged) as (
        select r.user_id, cast(0 as bigint), cast(0 as bigint), epoch_us(r.ts), cast(0 as bigint),
          epoch_us(r.ts), cast(0 as bigint), epoch_us(r.ts), cast(l.remaining_budget as bigint),
          cast(null as bigint), l.plan_id, cast(null as timestamp), cast(null as int),
          cast(null as varchar), cast(null as varchar), cast(0 as bigint)
        from numbered_requests r join limits l on l.user_id = r.user_id where r.n = 1
        union all
        select user_id, n,
          {kept('case when paid then h1 + tokens - oh else h1 end', 'h0')},
          {kept('hs1', 'hs0')},
          {kept('case when paid then d1 + tokens - od else d1 end', 'd0')},
          {kept('ds1', 'ds0')},
          {kept('case when paid then m1 + tokens - om else m1 end', 'm0')},
          {kept('ms1', 'ms0')},
          case when paid then b - need else b end, request_seq, plan_id, ts, tokens, validate_msg,
          case when passed then record end, case when paid then need else 0 end
        from (
          select *, passed and record in ('SUCCESS', 'SUCCESS_USING_OVERFLOW') as paid from (
            select *, validate_msg in ('ALLOWED', 'ALLOWED_USING_BUDGET') as passed from (
              select *,
                case when hit = '' then 'ALLOWED'
                     when not allow_budget then hit || '_LIMIT_EXCEEDED'
                     when is_active and b >= 0.02 * token_budget then 'ALLOWED_USING_BUDGET'
                     else hit || '_LIMIT_EXCEEDED + INSUFFICIENT_BUDGET' end as validate_msg,
                case when need = 0 then 'SUCCESS' when not allow_budget then 'PLAN_LIMIT_EXCEEDED'
                     when b > need then 'SUCCESS_USING_OVERFLOW'
                     when b = need then 'CHECK_VIOLATION' else 'INSUFFICIENT_BUDGET' end as record
              from (
                select *, greatest(oh, od, om) as need from (
                  select *,
                    concat_ws(' ', case when h1 >= hl then 'HOURLY' end,
                      case when d1 >= dl then 'DAILY' end,
                      case when m1 >= ml then 'MONTHLY' end) as hit,
                    greatest(0, h1 + tokens - hl) as oh, greatest(0, d1 + tokens - dl) as od,
                    greatest(0, m1 + tokens - ml) as om
                  from (
                    select g.user_id, r.n, r.request_seq, g.plan_id, r.ts, r.tokens,
                      r.allow_budget, l.hl, l.dl, l.ml, l.token_budget, l.is_active, g.b,
                      g.h as h0, g.hs as hs0, g.d as d0, g.ds as ds0, g.m as m0, g.ms as ms0,
                      case when epoch_us(r.ts) - g.hs >= 3600000000 then 0 else g.h end as h1,
                      case when epoch_us(r.ts) - g.hs >= 3600000000 then epoch_us(r.ts)
                           else g.hs end as hs1,
                      case when epoch_us(r.ts) - g.ds >= 24*3600000000 then 0 else g.d end as d1,
                      case when epoch_us(r.ts) - g.ds >= 24*3600000000 then epoch_us(r.ts)
                           else g.ds end as ds1,
                      case when epoch_us(r.ts) - g.ms >= 672*3600000000 then 0 else g.m end as m1,
                      case when epoch_us(r.ts) - g.ms >= 672*3600000000 then epoch_us(r.ts)
                           else g.ms end as ms1
                    from gate g join numbered_requests r
                      on r.user_id = g.user_id and r.n = g.n + 1
                    join limits l on l.user_id = g.user_id) a) b0) c) d0) e) f)"""


GATE_VIEWS = ["numbered_requests", "limits"]


def gate_sql(body: str, mode: str = "procedure") -> str:
    return using(GATE_VIEWS, body, recursive=_gate_cte(mode))


OUTCOME_SQL = """
  select request_seq, user_id, plan_id, ts, tokens, validate_msg, record_msg,
    coalesce(record_msg, validate_msg) as outcome, charged, h as hourly_token, d as daily_token,
    m as monthly_token, b as remaining_budget
  from gate where n > 0"""


def outcomes(t: Tables, mode: str = "procedure") -> DataFrame:
    return replay.replay_gate(t.gate_requests(), t.users(), t.plans(), mode=mode)


@query("quo5_replay_gate", gate_sql(OUTCOME_SQL))
def replay_all(t: Tables) -> DataFrame:
    return outcomes(t)


@query("quo5_replay_gate_api_mode", gate_sql(OUTCOME_SQL, "api"))
def _(t: Tables) -> DataFrame:
    return outcomes(t, "api")


@query(
    "quo5_replay_in_pieces",
    gate_sql(OUTCOME_SQL),
)
def _(t: Tables) -> DataFrame:
    """The path for long histories, taken here by every user: ordered pieces, state carried on."""
    rows = t.gate_requests().count()
    return replay.replay_gate(
        t.gate_requests(), t.users(), t.plans(), long_rows=0, piece_rows=max(1, rows // 4)
    )


@query(
    "quo5_final_state",
    gate_sql(
        """select user_id, plan_id, h as hourly_token, d as daily_token, m as monthly_token,
             b as remaining_budget from gate g
           where n = (select max(n) from numbered_requests r where r.user_id = g.user_id)"""
    ),
)
def _(t: Tables) -> DataFrame:
    return replay.final_state(outcomes(t))


@query(
    "quo5_log_rows",
    gate_sql(
        """select request_seq, user_id, plan_id, ts as time_stamp, 'success' as query_status,
             cast(tokens as bigint) as tokens_used, false as is_full
           from gate where n > 0 and record_msg in ('SUCCESS', 'SUCCESS_USING_OVERFLOW')
           union all
           select request_seq, user_id, plan_id, ts,
             case when record_msg in ('SUCCESS', 'SUCCESS_USING_OVERFLOW') then 'success'
                  else 'failed' end, tokens, true
           from gate where n > 0 and record_msg is not null
           union all
           select request_seq, user_id, plan_id, ts, 'failed', 0, false
           from gate where n > 0 and record_msg is null"""
    ),
)
def _(t: Tables) -> DataFrame:
    return replay.log_rows(outcomes(t))


@query(
    "quo6_init_usage",
    using(
        ["users", "usage"],
        f"""select user_id, 0 as hourly_token, timestamp '{NOW}' as hourly_session_start,
              0 as daily_token, timestamp '{NOW}' as daily_session_start, 0 as monthly_token,
              timestamp '{NOW}' as monthly_session_start
            from users where user_id not in (select user_id from usage)""",
    ),
)
def _(t: Tables) -> DataFrame:
    return gate.init_usage(t.users(), now(), t.usage())


@query(
    "quo7_blocked_log",
    using(
        ["gate_requests", "limits", "usage"],
        f"""select user_id, plan_id, ts as time_stamp, 'failed' as query_status, 0 as tokens_used
            from ({_validate_sql("select * from usage")}) v
            where validate_msg not in ('ALLOWED', 'ALLOWED_USING_BUDGET')""",
    ),
)
def _(t: Tables) -> DataFrame:
    return gate.blocked_log(
        gate.validate_requests(t.gate_requests(), t.users(), t.usage(), t.plans())
    )


@query(
    "agg6_gate_violations",
    gate_sql(
        """select user_id, plan_id, usage_day, window_kind, message,
             count(*) as blocked_requests
           from (
             select user_id, plan_id, date_trunc('day', ts) as usage_day, validate_msg as message,
               k as window_kind
             from gate join (values ('hourly'), ('daily'), ('monthly')) as w(k)
               on contains(validate_msg, upper(k))
             where n > 0 and record_msg is null) x
           group by all"""
    ),
)
def _(t: Tables) -> DataFrame:
    return marts.gate_violations(outcomes(t))
