"""Independent SQL for every registered query, run by DuckDB on the same parquet tables."""

from __future__ import annotations

# The metering tables as views over the driver's tables; ``fixtures.Tables`` builds the same rows.
VIEWS: dict[str, tuple[list[str], str]] = {
    "plans": (
        [],
        """select r_regionkey as plan_id, r_name as plan_name,
             60+20*r_regionkey as hourly_token_limit, 150+50*r_regionkey as daily_token_limit,
             1500+500*r_regionkey as monthly_token_limit, r_regionkey <> 4 as is_active
           from region""",
    ),
    "users": (
        [],
        """select cast(c_custkey as int) as user_id, c_name as user_name, n_regionkey as plan_id,
             cast(200+100*(c_custkey%5) as int) as token_budget,
             cast(200+100*(c_custkey%5) as int) as remaining_budget,
             c_custkey%10 <> 9 as is_active
           from customer join nation on c_nationkey=n_nationkey""",
    ),
    "plan_versions": (
        ["plans"],
        """select p.plan_id, p.plan_name, p.hourly_token_limit+10*k as hourly_token_limit,
             p.daily_token_limit, p.monthly_token_limit, p.is_active,
             case k when 0 then timestamp '2024-01-01 00:00:00'
                    when 1 then timestamp '2024-01-08 00:00:00'
                    when 2 then timestamp '2024-01-15 12:00:00'
                    else timestamp '2024-01-22 00:00:00' end as start_at
           from plans p cross join (values (0),(1),(2),(3)) as v(k)
           where not (p.plan_id=3 and k=0)""",
    ),
    "plan_history": (
        ["plan_versions"],
        """select *, lead(start_at) over (partition by plan_id order by start_at) as end_at
           from plan_versions""",
    ),
    "gate_requests": (
        [],
        """select event_id as request_seq, cast(user_id as int) as user_id, ts,
             cast(floor(value) as int) as tokens, event_id%2=0 as allow_budget
           from events""",
    ),
    "query_log": (
        ["users"],
        """select 2*event_id as q_id, cast(e.user_id as int) as user_id, u.plan_id,
             ts as time_stamp, 'success' as query_status,
             cast(floor(value) as int) as tokens_used,
             cast(null as varchar) as conversation_id, 'llm_query' as message_type
           from events e join users u on u.user_id=e.user_id where event_type<>'error'
           union all
           select 2*event_id+1, case when event_id%101=0 then null else cast(e.user_id as int) end,
             u.plan_id, ts, case when event_type='error' then 'failed' else 'success' end,
             case when event_id%89=0 then null else cast(floor(value) as int) end,
             'c' || event_id, 'llm_query'
           from events e join users u on u.user_id=e.user_id
           union all
           select 2*event_id+1, cast(e.user_id as int), u.plan_id, ts,
             case when event_type='error' then 'failed' else 'success' end,
             cast(floor(value) as int), 'c' || event_id, 'llm_query'
           from events e join users u on u.user_id=e.user_id
           where event_id%50=1 and event_id%101<>0 and event_id%89<>0""",
    ),
    "clean_queries": (
        ["query_log"],
        """select distinct * from query_log where user_id is not null""",
    ),
    "request_log": (
        [],
        """select event_id as log_id,
             case when event_id%103=0 then null else 'r' || event_id end as request_id,
             cast(user_id as int) as user_id,
             case when event_type in ('purchase','signup') then 'POST' else 'GET' end
               as http_method,
             '/' || event_type as endpoint, props as request_params,
             case when event_type<>'error' then 200 when event_id%3=0 then 500 else 400 end
               as response_status_code,
             case when event_id%97=0 then null else cast(floor(value*1000) as int) end
               as execution_time_ms,
             '10.0.0.' || (event_id%250) as client_ip, ts as "timestamp"
           from events""",
    ),
    "traces": (
        [],
        """select event_id as request_id, case when event_type='error' then 'ERROR' else 'INFO' end
             as last_level from events""",
    ),
    "usage": (
        [],
        """select cast(user_id as int) as user_id,
             cast(coalesce(sum(case when ts >= timestamp '2024-01-29' then floor(value) end), 0)
               as int) as hourly_token,
             coalesce(min(case when ts >= timestamp '2024-01-29' then ts end), max(ts))
               as hourly_session_start,
             cast(coalesce(sum(case when ts >= timestamp '2024-01-27' then floor(value) end), 0)
               as int) as daily_token,
             coalesce(min(case when ts >= timestamp '2024-01-27' then ts end), max(ts))
               as daily_session_start,
             cast(sum(floor(value)) as int) as monthly_token,
             min(ts) as monthly_session_start
           from events group by user_id""",
    ),
    "user_changes": (
        [],
        """select 'users' as topic, 0 as part, o_orderkey as offset_,
             cast(o_custkey as int) as user_id, cast(o_orderkey%5 as int) as plan_id,
             cast(floor(o_totalprice) as int) as remaining_budget,
             case when o_orderstatus='P' and o_orderkey%10=0 then 'd' else 'u' end as op,
             o_orderdate as changed_at
           from orders""",
    ),
    "user_snapshots": (
        [],
        """select snap_year, user_id, status from (
             select cast(year(o_orderdate) as int) as snap_year, cast(o_custkey as int) as user_id,
               o_orderstatus as status,
               row_number() over (partition by o_custkey, year(o_orderdate)
                                  order by o_orderdate desc, o_orderkey desc) as rn
             from orders) t where rn=1""",
    ),
    # SCD2 of user_changes: the last change of a tie counts, a delete only closes
    "log_history": (
        ["user_changes"],
        """select user_id, plan_id, remaining_budget, epoch_ms(changed_at) as start_ms,
             epoch_ms(next_at) as end_ms
           from (
             select *, lead(changed_at) over (partition by user_id order by changed_at) as next_at
             from (select *, row_number() over (partition by user_id, changed_at
                                                order by offset_ desc) as rn from user_changes) a
             where rn = 1) b
           where op <> 'd'""",
    ),
    # SCD2 of user_snapshots, by joining each snapshot row with the same key one year before
    "snapshot_history": (
        ["user_snapshots"],
        """select user_id, status, min(snap_year) as start_year,
             case when max(snap_year) = (select max(snap_year) from user_snapshots) then null
                  else max(snap_year) + 1 end as end_year
           from (
             select *, sum(opens) over (partition by user_id order by snap_year) as island
             from (
               select c.*, case when p.user_id is null or p.status is distinct from c.status
                           then 1 else 0 end as opens
               from user_snapshots c left join user_snapshots p
                 on p.user_id = c.user_id and p.snap_year = c.snap_year - 1) a) b
           group by user_id, island, status""",
    ),
    "limits": (
        ["users", "plans"],
        """select u.user_id, u.plan_id, u.token_budget, u.remaining_budget, u.is_active,
             p.hourly_token_limit as hl, p.daily_token_limit as dl, p.monthly_token_limit as ml
           from users u join plans p on p.plan_id = u.plan_id""",
    ),
    "numbered_requests": (
        ["gate_requests"],
        """select *, row_number() over (partition by user_id order by ts, request_seq) as n
           from gate_requests""",
    ),
}


def using(names: list[str], body: str, recursive: str = "") -> str:
    """``body`` behind the views it needs; ``recursive`` is one more, recursive, CTE."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][0]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    ctes = [f"{n} as materialized ({VIEWS[n][1]})" for n in order]
    if recursive:
        ctes.append(recursive)
    word = "with recursive" if recursive else "with"
    return f"{word} {', '.join(ctes)} {body}" if ctes else body
