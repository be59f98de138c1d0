"""Queries over dimension changes, log appends and reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterhouse.functions.columns import estimate_tokens
from meterhouse.operators import dimensions as dims
from meterhouse.operators import reads
from meterhouse.plans.fixtures import Tables
from meterhouse.plans.oracles import using
from meterhouse.plans.queries_quota import NOW, now
from meterhouse.plans.registry import query


def with_status(t: Tables, commands: DataFrame, statuses: DataFrame) -> DataFrame:
    return commands.join(statuses, "cmd_seq")


# --- dimension changes -----------------------------------------------------------------------


def plan_orders(t: Tables) -> DataFrame:
    """Plans to create, from the parts: some without a name, many names and limits unfit."""
    key = F.col("p_partkey")
    return t.raw("part").select(
        key.alias("cmd_seq"),
        F.when(key % 37 != 0, F.concat_ws(" ", "p_brand", "p_type", "p_size")).alias("plan_name"),
        (F.col("p_size") - 3).cast("int").alias("hourly_token_limit"),
        (F.col("p_size") * 20).cast("int").alias("daily_token_limit"),
        F.when(key % 5 != 0, F.col("p_size") * 400).cast("int").alias("monthly_token_limit"),
    )


PLAN_ORDERS_SQL = """
  select p_partkey as cmd_seq,
    case when p_partkey%37=0 then null else p_brand || ' ' || p_type || ' ' || p_size end
      as plan_name,
    p_size-3 as hourly_token_limit, p_size*20 as daily_token_limit,
    coalesce(case when p_partkey%5<>0 then p_size*400 end, 100000) as monthly_token_limit
  from part"""
PLAN_JUDGED_SQL = f"""
  select *, case when plan_name is null then 'null_name' when not fit then 'limit_not_positive'
                 when rn = 1 then 'success' else 'duplicate_name' end as status
  from (
    select *, row_number() over (partition by plan_name, fit order by cmd_seq) as rn
    from (select *, hourly_token_limit > 0 and daily_token_limit > 0 and monthly_token_limit > 0
            as fit from ({PLAN_ORDERS_SQL}) o) a) b"""


@query(
    "dim1_create_plans",
    using(
        ["plans"],
        f"""select * from plans
            union all
            select cast(4 + row_number() over (order by cmd_seq) as int), plan_name,
              hourly_token_limit, daily_token_limit, monthly_token_limit, true
            from ({PLAN_JUDGED_SQL}) j where status = 'success'""",
    ),
)
def _(t: Tables) -> DataFrame:
    return dims.create_plans(t.plans(), plan_orders(t))[0]


@query("dim1_create_plans_status", f"select cmd_seq, status from ({PLAN_JUDGED_SQL}) j")
def _(t: Tables) -> DataFrame:
    return dims.create_plans(t.plans(), plan_orders(t))[1]


def limit_orders(t: Tables) -> DataFrame:
    """Limit updates from the orders, on seven plan ids of which two do not exist; some are illegal."""
    key = F.col("o_orderkey")
    return t.raw("orders").select(
        key.alias("cmd_seq"),
        (key % 7).cast("int").alias("plan_id"),
        F.when(key % 17 == 0, F.lit(-5))
        .otherwise((F.floor(F.col("o_totalprice") / 100000) + 60).cast("int"))
        .alias("hourly_token_limit"),
        F.lit(500).alias("daily_token_limit"),
        F.lit(5000).alias("monthly_token_limit"),
    )


LIMIT_ORDERS_SQL = """
  select o_orderkey as cmd_seq, cast(o_orderkey%7 as int) as plan_id,
    case when o_orderkey%17 = 0 then -5 else cast(floor(o_totalprice/100000) + 60 as int) end as hl
  from orders"""


@query(
    "dim2_update_plans",
    using(
        ["plans"],
        f"""select p.plan_id, p.plan_name,
              case when is_active and l.hl is not null then l.hl else hourly_token_limit end
                as hourly_token_limit,
              case when is_active and l.hl is not null then 500 else daily_token_limit end
                as daily_token_limit,
              case when is_active and l.hl is not null then 5000 else monthly_token_limit end
                as monthly_token_limit, p.is_active
            from plans p left join (select plan_id, arg_max(hl, cmd_seq) as hl
                                    from ({LIMIT_ORDERS_SQL}) o where hl > 0 group by plan_id) l
              on l.plan_id = p.plan_id""",
    ),
)
def _(t: Tables) -> DataFrame:
    return dims.update_plans(t.plans(), limit_orders(t))[0]


@query(
    "dim2_update_plans_status",
    using(
        ["plans"],
        f"""select cmd_seq, case when coalesce(is_active, false) and changed then 'success'
                                 else 'plan_is_inactive' end as status
            from (
              select o.*, p.is_active,
                coalesce(lag(o.hl) over (partition by o.plan_id order by cmd_seq) <> o.hl,
                         p.hourly_token_limit <> o.hl or p.daily_token_limit <> 500
                         or p.monthly_token_limit <> 5000) as changed
              from (select * from ({LIMIT_ORDERS_SQL}) where hl > 0) o
                left join plans p on p.plan_id = o.plan_id) x
            union all
            select cmd_seq, 'limit_not_positive' from ({LIMIT_ORDERS_SQL}) where hl <= 0""",
    ),
)
def _(t: Tables) -> DataFrame:
    return dims.update_plans(t.plans(), limit_orders(t))[1]


@query(
    "dim3_soft_delete_users",
    using(
        ["users"],
        """select * replace (is_active and user_id not in
             (select user_id from events where event_type = 'signup') as is_active) from users""",
    ),
)
def _(t: Tables) -> DataFrame:
    leavers = t.events().where("event_type = 'signup'").select(
        F.col("event_id").alias("cmd_seq"), "user_id"
    )
    return dims.soft_delete(t.users(), leavers, "user_id")[0]


@query(
    "dim4_hard_delete_plans",
    """select n_nationkey as cmd_seq, n_nationkey as plan_id,
         case when n_nationkey not in (select s_nationkey from supplier
                                       union all select c_nationkey + 10 from customer)
              then 'success' else 'still_referenced' end as status
       from nation
       union all
       select 100 + n_nationkey, 100 + n_nationkey,
         case when 100 + n_nationkey in (select s_nationkey from supplier
                                         union all select c_nationkey + 10 from customer)
              then 'unknown' else 'unknown' end from nation""",
)
def _(t: Tables) -> DataFrame:
    """Plans named after nations; suppliers and customers hold some of them."""
    table = t.raw("nation").select(F.col("n_nationkey").alias("plan_id"), "n_name")
    wanted = table.select(F.col("plan_id").alias("cmd_seq"), "plan_id")
    wanted = wanted.unionByName(
        wanted.select((F.col("cmd_seq") + 100).alias("cmd_seq"), (F.col("plan_id") + 100).alias("plan_id"))
    )
    holders = [
        (t.raw("supplier"), "s_nationkey"),
        (t.raw("customer").select((F.col("c_nationkey") + 10).alias("n")), "n"),
    ]
    _, statuses = dims.hard_delete(table, wanted, "plan_id", holders)
    return with_status(t, wanted, statuses)


@query(
    "dim4_plans_left",
    """select p_partkey as plan_id from part
       where p_partkey%3 <> 0 or p_partkey in (select l_partkey from lineitem)""",
)
def _(t: Tables) -> DataFrame:
    table = t.raw("part").select(F.col("p_partkey").alias("plan_id"))
    wanted = table.select(F.col("plan_id").alias("cmd_seq"), "plan_id").where("plan_id % 3 = 0")
    return dims.hard_delete(table, wanted, "plan_id", [(t.raw("lineitem"), "l_partkey")])[0]


@query(
    "dim5_migrate_users",
    using(
        ["users"],
        """select user_id, user_name,
             cast(case when is_active then r.place else u.plan_id end as int) as plan_id,
             token_budget, remaining_budget, is_active
           from users u join (
             select origin, place from walk where since = (select max(cmd_seq) from moves)) r
             on r.origin = u.plan_id""",
        recursive="""
          moves as (select n_nationkey as cmd_seq, n_regionkey as old_plan,
                      cast((n_nationkey * 3 + 1) % 6 as int) as new_plan from nation),
          walk(origin, place, since) as (
            select r_regionkey, r_regionkey, -1 from region
            union all
            select w.origin, case when m.old_plan = w.place and m.new_plan <= 4 then m.new_plan
                                  else w.place end, m.cmd_seq
            from walk w join moves m on m.cmd_seq = w.since + 1)""",
    ),
)
def _(t: Tables) -> DataFrame:
    """Twenty-five moves, some onto plans that others empty later, some onto no plan at all."""
    key = F.col("n_nationkey")
    moves = t.raw("nation").select(
        key.cast("bigint").alias("cmd_seq"),
        F.col("n_regionkey").alias("old_plan"),
        ((key * 3 + 1) % 6).cast("int").alias("new_plan"),
    )
    return dims.migrate_users(t.users(), moves, t.plans())[0]


def user_orders(t: Tables) -> DataFrame:
    """Users to create, from the suppliers: unknown plans, negative budgets, names in use."""
    key = F.col("s_suppkey")
    return t.raw("supplier").select(
        key.alias("cmd_seq"),
        F.when(key % 10 == 3, F.concat(F.lit("dup"), (key / 20).cast("int")))
        .otherwise(F.col("s_name"))
        .alias("user_name"),
        (F.col("s_nationkey") % 7).alias("plan_id"),
        F.floor("s_acctbal").cast("int").alias("budget"),
    )


USER_JUDGED_SQL = """
  select *, case when plan_id > 4 then 'unknown_plan' when budget <= 0 then 'budget_not_positive'
                 when rn = 1 then 'success' else 'duplicate_name' end as status
  from (
    select *, row_number() over (partition by user_name, plan_id <= 4 and budget > 0
                                 order by cmd_seq) as rn
    from (
      select s_suppkey as cmd_seq, case when s_suppkey%10=3 then 'dup' || (s_suppkey//20)
                                        else s_name end as user_name,
        s_nationkey%7 as plan_id, cast(floor(s_acctbal) as int) as budget from supplier) a) b"""


@query(
    "dim6_create_users",
    using(
        ["users"],
        f"""select * from users
            union all
            select cast((select max(user_id) from users) + row_number() over (order by cmd_seq)
                   as int), user_name, plan_id, budget, budget, true
            from ({USER_JUDGED_SQL}) j where status = 'success'""",
    ),
)
def _(t: Tables) -> DataFrame:
    return dims.create_users(t.users(), t.plans(), user_orders(t), now())[0]


@query("dim6_create_users_status", f"select cmd_seq, status from ({USER_JUDGED_SQL}) j")
def _(t: Tables) -> DataFrame:
    return dims.create_users(t.users(), t.plans(), user_orders(t), now())[1]


@query(
    "dim6_create_users_usage",
    using(
        ["users"],
        f"""select cast((select max(user_id) from users) + row_number() over (order by cmd_seq)
              as int) as user_id, 0 as hourly_token, timestamp '{NOW}' as hourly_session_start,
              0 as daily_token, timestamp '{NOW}' as daily_session_start,
              0 as monthly_token, timestamp '{NOW}' as monthly_session_start
            from ({USER_JUDGED_SQL}) j where status = 'success'""",
    ),
)
def _(t: Tables) -> DataFrame:
    return dims.create_users(t.users(), t.plans(), user_orders(t), now())[2]


def rename_orders(t: Tables) -> DataFrame:
    """User updates from the orders: many per user, some onto unknown plans or without a value."""
    key = F.col("o_orderkey")
    return t.raw("orders").select(
        key.alias("cmd_seq"),
        F.col("o_custkey").cast("int").alias("user_id"),
        F.when(key % 17 != 0, F.concat(F.lit("user "), key)).alias("user_name"),
        (key % 7).cast("int").alias("plan_id"),
        F.when(key % 19 != 0, (F.floor(F.col("o_totalprice") / 1000) - 20).cast("int")).alias("budget"),
    )


RENAME_SQL = """
  select o_orderkey as cmd_seq, cast(o_custkey as int) as user_id,
    case when o_orderkey%17 <> 0 then 'user ' || o_orderkey end as name,
    cast(o_orderkey%7 as int) as plan,
    case when o_orderkey%19 <> 0 then cast(floor(o_totalprice/1000) - 20 as int) end as budget
  from orders"""


@query(
    "dim7_update_users",
    using(
        ["users"],
        f"""select u.user_id, coalesce(r.name, u.user_name) as user_name,
              coalesce(r.plan, u.plan_id) as plan_id,
              coalesce(r.budget, u.token_budget) as token_budget,
              coalesce(r.budget, u.remaining_budget) as remaining_budget, u.is_active
            from users u left join (
              select user_id, arg_max(name, cmd_seq) as name, arg_max(plan, cmd_seq) as plan,
                arg_max(budget, cmd_seq) as budget
              from ({RENAME_SQL}) o where plan <= 4 and budget > 0 and name is not null
              group by user_id) r
              on r.user_id = u.user_id and u.is_active""",
    ),
)
def _(t: Tables) -> DataFrame:
    return dims.update_users(t.users(), t.plans(), rename_orders(t))[0]


@query(
    "dim7_update_users_status",
    using(
        ["users"],
        f"""select o.cmd_seq, case when not u.is_active then 'no_effect'
              when o.plan > 4 then 'unknown_plan' when o.name is null then 'null_name'
              when o.budget is null then 'null_budget' when o.budget <= 0 then 'budget_not_positive'
              else 'success' end as status
            from ({RENAME_SQL}) o join users u on u.user_id = o.user_id""",
    ),
)
def _(t: Tables) -> DataFrame:
    return dims.update_users(t.users(), t.plans(), rename_orders(t))[1]


TOP_UPS_SQL = """select o_orderkey as cmd_seq, o_custkey as user_id,
    case when o_orderkey % 11 = 0 then null when o_orderkey % 13 = 0 then -1000000000
         else cast(floor(o_totalprice/1000) as bigint) end as tokens from orders"""


def top_ups(t: Tables) -> DataFrame:
    """An order adds its price in thousands; some have none, some would take more than there is."""
    seq = F.col("o_orderkey")
    return t.raw("orders").select(
        seq.alias("cmd_seq"),
        F.col("o_custkey").cast("int").alias("user_id"),
        F.when(seq % 11 == 0, F.lit(None))
        .when(seq % 13 == 0, F.lit(-1_000_000_000))
        .otherwise(F.floor(F.col("o_totalprice") / 1000))
        .alias("tokens"),
    )


@query(
    "dim8_add_budget",
    using(
        ["users"],
        f"""select * replace (
             cast(token_budget + case when is_active then coalesce(added, 0) else 0 end as int)
               as token_budget,
             cast(remaining_budget + case when is_active then coalesce(added, 0) else 0 end
               as int) as remaining_budget)
           from (select u.*, o.added from users u left join (
             select user_id, sum(tokens) as added from ({TOP_UPS_SQL}) c where tokens > 0
             group by user_id) o on o.user_id = u.user_id) x""",
    ).replace("select * replace (", "select * exclude (added) replace ("),
)
def _(t: Tables) -> DataFrame:
    return dims.add_budget(t.users(), top_ups(t))[0]


@query(
    "dim8_add_budget_status",
    using(
        ["users"],
        f"""select c.cmd_seq, case when u.user_id is null then 'no_effect'
              when tokens is null then 'null_tokens'
              when tokens < 0 then 'budget_not_positive_or_too_large' else 'success' end as status
            from ({TOP_UPS_SQL}) c left join (select * from users where is_active) u
              on u.user_id = c.user_id""",
    ),
)
def _(t: Tables) -> DataFrame:
    return dims.add_budget(t.users(), top_ups(t))[1]


@query(
    "dim9_append_query_log",
    using(
        ["users"],
        """select 10 * event_id as q_id, cast(user_id as int) as user_id, 'success' as query_status,
             cast(floor(value) as int) as tokens_used, 'validation_check' as message_type,
             true as allow_budget_override, true as is_successful
           from events where event_type <> 'error'
           union all
           select (select max(10 * event_id) from events where event_type <> 'error')
               + row_number() over (order by event_id), cast(user_id as int), 'failed',
             cast(floor(value) as int), 'llm_query', false, true
           from events where event_type = 'error'""",
    ),
)
def _(t: Tables) -> DataFrame:
    """Bare rows appended to a log of full ones: missing columns take their defaults."""
    e = t.events()
    log = e.where("event_type <> 'error'").select(
        (10 * F.col("event_id")).alias("q_id"),
        "user_id",
        F.lit("success").alias("query_status"),
        F.col("tokens").alias("tokens_used"),
        F.lit("validation_check").alias("message_type"),
        F.lit(True).alias("allow_budget_override"),
        F.lit(True).alias("is_successful"),
    )
    bare = e.where("event_type = 'error'").select(
        F.col("event_id").alias("cmd_seq"),
        "user_id",
        F.lit("failed").alias("query_status"),
        F.col("tokens").alias("tokens_used"),
    )
    return dims.append_query_log(log, bare).select(*log.columns)


@query(
    "dim9_append_request_log",
    using(
        ["request_log"],
        """select log_id, request_id, endpoint from request_log where endpoint <> '/error'
           union all
           select (select max(log_id) from request_log where endpoint <> '/error')
             + row_number() over (order by log_id), request_id, endpoint
           from request_log where endpoint = '/error'""",
    ),
)
def _(t: Tables) -> DataFrame:
    """Every old request id is sent a second time and refused."""
    rows = t.request_log().select("log_id", "request_id", "endpoint")
    log = rows.where("endpoint <> '/error'")
    new = rows.where("endpoint = '/error' or request_id is not null and endpoint = '/click'")
    commands = new.withColumnRenamed("log_id", "cmd_seq")
    return dims.append_request_log(log, commands)


# --- reads -----------------------------------------------------------------------------------


@query(
    "rd1_active_plans",
    using(
        ["plans"],
        """select plan_id, plan_name, hourly_token_limit, daily_token_limit, monthly_token_limit
           from plans where is_active""",
    ),
)
def _(t: Tables) -> DataFrame:
    return reads.active_plans(t.plans())


@query("rd1_plan_details", using(["plans"], "select * from plans where plan_id = 4"))
def _(t: Tables) -> DataFrame:
    return reads.plan_details(t.plans(), 4)


@query("rd2_list_users", using(["users"], "select * from users"))
def _(t: Tables) -> DataFrame:
    return reads.list_users(t.users())


@query("rd2_user_details", using(["users"], "select * from users where user_id = 9"))
def _(t: Tables) -> DataFrame:
    return reads.user_details(t.users(), 9)


@query(
    "rd3_active_users",
    using(
        ["users"],
        "select user_id, user_name || ' (id ' || user_id || ')' as label from users where is_active",
    ),
)
def _(t: Tables) -> DataFrame:
    return reads.active_users(t.users())


@query("rd4_current_usage", using(["usage"], "select * from usage"))
def _(t: Tables) -> DataFrame:
    return reads.current_usage(t.usage())


@query("rd5_query_history", using(["query_log"], "select * from query_log where user_id = 8"))
def _(t: Tables) -> DataFrame:
    return reads.query_history(t.query_log(), 8)


CHAT_SQL = """
  select user_id, recency, q_id, conversation_id, cast(null as varchar) as user_message,
    cast(null as varchar) as llm_response, tokens_used,
    cast(null as varchar) as validation_result, query_status, time_stamp
  from (select *, row_number() over (partition by user_id order by time_stamp desc, q_id desc)
          as recency from query_log where user_id is not null) x
  where recency <= 100"""


@query("rd6_chat_history", using(["query_log"], CHAT_SQL))
def _(t: Tables) -> DataFrame:
    """The latest hundred of every user at once."""
    return reads.chat_history(t.query_log())


@query(
    "rd6_chat_history_of_user",
    using(
        ["query_log"], f"select * exclude (user_id, recency) from ({CHAT_SQL}) h where user_id = 8"
    ),
)
def _(t: Tables) -> DataFrame:
    return reads.chat_history(t.query_log(), user_id=8)


def chat_log(t: Tables) -> DataFrame:
    """Conversations as log rows: a user turn with the answer turn after it."""
    talks = t.raw("conversations")
    asked = talks.where("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("user_message")
    )
    answered = talks.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("llm_response")
    )
    return asked.join(answered, ["conv_id", "turn"], "left").withColumns(
        {
            "query_status": F.when(F.col("llm_response").isNull(), "failed").otherwise("success"),
            "tokens_used": estimate_tokens(F.col("user_message")),
        }
    )


TRANSCRIPT_SQL = """
  with chat as (
    select u.conv_id, u.turn, u.text as user_message, a.text as llm_response,
      case when a.text is null then 'failed' else 'success' end as query_status,
      greatest(50, 10 * len(regexp_extract_all(u.text,
        '[^\\s\\x0B\\x1C-\\x1F\\x{85}\\p{Z}]+'))) as tokens_used
    from conversations u left join conversations a
      on a.conv_id = u.conv_id and a.turn = u.turn + 1 and a.role = 'assistant'
    where u.role = 'user')
  select conv_id, turn, 1 as part, 'user' as speaker, user_message as text,
    cast(null as varchar) as note from chat
  union all
  select conv_id, turn, 2, 'bot', llm_response,
    query_status || ' · ' || format('{:,}', tokens_used) || ' tokens' from chat"""


@query("rd7_chat_transcript", TRANSCRIPT_SQL)
def _(t: Tables) -> DataFrame:
    return reads.chat_transcript(chat_log(t), ["conv_id", "turn"])


@query("rd8_request_logs", using(["request_log"], "select * from request_log"))
def _(t: Tables) -> DataFrame:
    return reads.request_logs(t.request_log(), limit=0)


@query(
    "rd8_latest_requests",
    using(
        ["request_log"],
        'select * from request_log order by "timestamp" desc, log_id desc limit 50',
    ),
)
def _(t: Tables) -> DataFrame:
    return reads.request_logs(t.request_log(), limit=50)


@query(
    "rd9_admin_log",
    using(
        ["request_log"],
        """select log_id, "timestamp", http_method, endpoint, response_status_code,
             case when response_status_code < 400 then 'OK' else 'Error' end as badge,
             execution_time_ms, 2 as trace_steps from request_log""",
    ),
)
def _(t: Tables) -> DataFrame:
    traces = t.traces().withColumnRenamed("request_id", "log_id")
    return reads.admin_log(t.request_log().join(traces, "log_id"))


@query(
    "rd10_user_dashboard",
    using(
        ["users", "usage", "limits", "query_log"],
        """select u.user_id, u.user_name, u.remaining_budget, l.hl - g.hourly_token
             as hourly_remaining, l.dl - g.daily_token as daily_remaining,
             l.ml - g.monthly_token as monthly_remaining, g.hourly_token, g.daily_token,
             g.monthly_token, coalesce(h.n, 0) as history_rows, coalesce(h.s, 0) as success_rows,
             coalesce(h.f, 0) as failed_rows
           from users u join usage g on g.user_id = u.user_id
           join limits l on l.user_id = u.user_id
           left join (select user_id, count(*) as n,
                        count(case when query_status='success' then 1 end) as s,
                        count(case when query_status='failed' then 1 end) as f
                      from query_log group by user_id) h on h.user_id = u.user_id
           where u.is_active""",
    ),
)
def _(t: Tables) -> DataFrame:
    return reads.user_dashboard(t.users(), t.usage(), t.plans(), t.query_log())
