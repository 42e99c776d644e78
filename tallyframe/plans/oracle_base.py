"""SQL (DuckDB dialect) twins of the test-data binding and staging models.

Each entry is a named CTE with its dependencies; :func:`sql` assembles the
CTEs a query needs, in dependency order, in front of the query body.  These
are written independently of the Spark code, from the same definitions, so
that the driver can compare the two.
"""

from __future__ import annotations

from .. import fixed_values as fv


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _pick(expr: str, values) -> str:
    """CASE choosing values[expr] for expr in 0..len-1 (the SQL twin of element_at(array, expr + 1))."""
    whens = " ".join(f"when {i} then {_q(v)}" for i, v in enumerate(values[:-1]))
    return f"case {expr} {whens} else {_q(values[-1])} end"


TICKET_CATEGORY_CASE = ("case lower(ticket_type) "
                        + " ".join(f"when {_q(k)} then {_q(v)}" for k, v in fv.TICKET_CATEGORY_MAP.items())
                        + " end")

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = (deps, body)


def sql(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = ",\n".join(f"{n} as (\n{CTES[n][1]}\n)" for n in order)
    return f"with {parts}\n{body}"


# --------------------------------------------------------------------------- raw text shapes

cte("raw_accounts", """
select cast(n_nationkey as varchar) as account_id,
       r_name as account_type,
       n_name as account_name,
       case when n_nationkey % 2 = 1 then '' else 'industry_' || cast(n_regionkey as varchar) end as industry,
       'active' as status,
       case when n_nationkey % 2 = 1 then '' else cast(8 + n_nationkey % 7 as varchar) end as per_member_rate
from nation left join region on n_regionkey = r_regionkey""")

cte("join_dates", """
select o_custkey, min(cast(o_orderdate as date)) as join_date from orders group by o_custkey""")

cte("raw_members", """
select cast(c_custkey as varchar) as member_id,
       cast(c_nationkey as varchar) as account_id,
       lower(c_name) || '@example.com' as email,
       cast(j.join_date as varchar) as join_date,
       'enrolled' as eligibility_status,
       case when c_custkey % 5 < 4 then 'True' else 'False' end as sponsored,
       case when c_custkey % 50 = 0 then 'True' else 'False' end as is_fitbit_seed
from customer left join join_dates j on c_custkey = j.o_custkey""", ("join_dates",))

cte("raw_plans", """
select o_orderpriority as plan_id, o_orderpriority as plan_name, o_orderpriority as tier,
       cast(10 + 5 * cast(substr(o_orderpriority, 1, 1) as integer) as varchar) as monthly_price
from (select distinct o_orderpriority from orders) p""")

cte("raw_subscriptions", """
select cast(o_orderkey as varchar) as subscription_id,
       cast(o_custkey as varchar) as member_id,
       o_orderpriority as plan_id,
       cast(cast(o_orderdate as date) as varchar) as start_date,
       case when o_orderstatus = 'O' then ''
            else cast(cast(o_orderdate as date) + cast(30 + o_orderkey % 300 as integer) as varchar) end as end_date,
       case when o_orderstatus = 'O' then 'active' else 'ended' end as status,
       cast(cast(o_totalprice as decimal(18,2)) as varchar) as billed_amount
from orders""")

cte("raw_orders", f"""
select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as order_id,
       cast(o_custkey as varchar) as member_id,
       {_pick('l_linenumber % 4', fv.ORDER_TYPES)} as order_type,
       cast(cast(l_shipdate as date) as varchar) as order_date,
       cast(cast(l_extendedprice as decimal(18,2)) as varchar) as amount,
       l_returnflag as status
from lineitem join orders on l_orderkey = o_orderkey""")

cte("raw_campaigns", f"""
select cast(s_suppkey as varchar) as campaign_id,
       s_name as campaign_name,
       {_pick('s_suppkey % 9', fv.CHANNELS)} as channel,
       cast(s_nationkey as varchar) as target_audience,
       cast(date '1995-01-01' + cast((s_suppkey * 97) % 400 as integer) as varchar) as start_date,
       cast(date '1995-01-01' + cast((s_suppkey * 97) % 400 + 14 + s_suppkey % 47 as integer) as varchar) as end_date,
       case when date '1995-01-01' + cast((s_suppkey * 97) % 400 + 14 + s_suppkey % 47 as integer) < date '2001-12-31'
            then 'completed' else 'active' end as status,
       cast(cast(abs(s_acctbal) * 110000 as decimal(18,2)) as varchar) as budget,
       cast(cast(abs(s_acctbal) * 100000 as decimal(18,2)) as varchar) as spend,
       cast(1000 + (s_suppkey * 37) % 9000 as varchar) as impressions,
       cast((s_suppkey * 13) % 1000 as varchar) as clicks,
       cast(s_suppkey % 400 as varchar) as conversions
from supplier""")

cte("raw_acquisition", """
select cast(s_nationkey as varchar) as account_id, cast(min(s_suppkey) as varchar) as campaign_id
from supplier group by s_nationkey""")

cte("raw_workouts", """
select cast(user_id as varchar) || '-' || cast(activity_date as varchar) as workout_id,
       cast(user_id as varchar) as member_id,
       cast(activity_date as varchar) as activity_date,
       cast(steps as varchar) as steps,
       cast(value_sum as varchar) as distance_km,
       cast(cast(floor(hi) as integer) as varchar) as very_active_minutes,
       cast(cast(floor(mid) as integer) as varchar) as moderately_active_minutes,
       cast(views as varchar) as light_active_minutes,
       cast(1440 - steps as varchar) as sedentary_minutes,
       cast(cast(floor(value_sum) as integer) as varchar) as calories_burned,
       case when user_id % 10 = 0 then 'real_fitbit' else 'synthetic' end as source
from (
  select user_id, cast(ts as date) as activity_date, count(*) as steps,
         cast(sum(cast(value as decimal(18,2))) as decimal(18,2)) as value_sum,
         sum(case when event_type in ('purchase', 'click') then cast(value as decimal(18,2)) end) as hi,
         sum(case when event_type in ('view', 'signup', 'error') then cast(value as decimal(18,2)) end) as mid,
         count_if(event_type = 'view') as views
  from events group by user_id, cast(ts as date)) d""")

cte("raw_tickets", """
select cast(event_id as varchar) as ticket_id,
       cast(user_id as varchar) as member_id,
       case event_type when 'view' then 'Technical issue' when 'click' then 'BILLING INQUIRY'
            when 'signup' then 'Product Inquiry' when 'purchase' then 'refund request'
            else event_type end as ticket_type,
       case when event_id % 2 = 1 then 'Open' else 'Closed' end as ticket_status,
       case event_id % 4 when 0 then 'Critical' when 1 then 'High' when 2 then 'Medium' else 'Low' end as ticket_priority,
       case user_id % 4 when 0 then 'Email' when 1 then 'Phone' when 2 then 'Chat' else 'Social media' end as ticket_channel,
       case when event_id % 3 = 0 then '' else cast(1 + event_id % 5 as varchar) || '.0' end as csat_rating,
       cast(cast(ts as date) as varchar) as created_at,
       case when event_id % 2 = 1 then '' else cast(cast(ts as date) + cast(event_id % 7 as integer) as varchar) end as resolved_at
from events""")

# --------------------------------------------------------------------------- typed shapes

cte("activity", """
select cast(user_id as varchar) as member_id, cast(ts as date) as activity_date,
       count(*) as steps,
       cast(sum(cast(value as decimal(18,2))) as decimal(18,2)) as value_sum,
       sum(cast(value as decimal(18,2))) >= 50 as is_active_day
from events group by user_id, cast(ts as date)""")

cte("accounts", """
select account_id, account_type, account_name, industry, status,
       cast(nullif(per_member_rate, '') as decimal(18,2)) as per_member_rate
from raw_accounts""", ("raw_accounts",))

cte("members", """
select member_id, account_id, email, cast(join_date as date) as join_date, eligibility_status,
       cast(sponsored as boolean) as sponsored, cast(is_fitbit_seed as boolean) as is_fitbit_seed
from raw_members""", ("raw_members",))

cte("plans", """
select plan_id, plan_name, tier, cast(monthly_price as decimal(18,2)) as monthly_price
from raw_plans""", ("raw_plans",))

cte("subscriptions", """
select subscription_id, member_id, plan_id, cast(start_date as date) as start_date,
       cast(nullif(end_date, '') as date) as end_date, status,
       cast(billed_amount as decimal(18,2)) as billed_amount
from raw_subscriptions""", ("raw_subscriptions",))

cte("one_time_orders", """
select order_id, member_id, order_type, cast(order_date as date) as order_date,
       cast(amount as decimal(18,2)) as amount, status
from raw_orders""", ("raw_orders",))

cte("campaigns", """
select campaign_id, campaign_name, channel, target_audience,
       cast(start_date as date) as start_date, cast(end_date as date) as end_date, status,
       cast(budget as decimal(18,2)) as budget, cast(spend as decimal(18,2)) as spend,
       cast(impressions as integer) as impressions, cast(clicks as integer) as clicks,
       cast(conversions as integer) as conversions
from raw_campaigns""", ("raw_campaigns",))

cte("acquisition", "select * from raw_acquisition", ("raw_acquisition",))

cte("streaks", """
select member_id, streak_start_date, streak_end_date, streak_length_days,
       cast(rank() over (partition by member_id order by streak_end_date desc) as bigint) as streak_recency_rank
from (
  select member_id, min(activity_date) as streak_start_date, max(activity_date) as streak_end_date,
         date_diff('day', min(activity_date), max(activity_date)) + 1 as streak_length_days
  from (
    select *, count(*) filter (where opens) over (partition by member_id order by activity_date) as island
    from (select member_id, activity_date,
                 coalesce(activity_date > lag(activity_date) over (partition by member_id order by activity_date) + 1, true) as opens
          from activity where is_active_day) o) i
  group by member_id, island) b""", ("activity",))

cte("as_of", "select max(activity_date) as as_of_date from activity", ("activity",))


# --------------------------------------------------------------------------- exact rounding in SQL
# DuckDB divides decimals in floating point; these helpers divide in integers
# so that half-way cases round exactly like Spark's decimal round (half up
# for the non-negative values used here).


def ratio_money_by_count(num: str, den: str) -> str:
    """round(num / den, 2) for a 2-place decimal num and a positive integer den."""
    return (f"cast(cast((2 * cast(round(({num}) * 100) as hugeint) + ({den})) // (2 * ({den})) "
            f"as decimal(38,0)) * 0.01 as decimal(18,2))")


def ratio_money_by_money(num: str, den: str) -> str:
    """round(num / den, 2) for two 2-place decimals, den > 0."""
    n = f"cast(round(({num}) * 100) as hugeint)"
    d = f"cast(round(({den}) * 100) as hugeint)"
    return f"cast(cast((200 * {n} + {d}) // (2 * {d}) as decimal(38,0)) * 0.01 as decimal(18,2))"


def avg_one_place(total: str, count: str, divisor: int = 1) -> str:
    """round(total / (count * divisor), 1) for integer total and count, null if count = 0."""
    t = f"cast({total} as hugeint)"
    c = f"cast({count} as hugeint)"
    return (f"case when {c} > 0 then cast(cast((20 * {t} + {divisor} * {c}) // (2 * {divisor} * {c}) "
            f"as decimal(38,0)) * 0.1 as decimal(18,1)) end")

cte("tickets", f"""
select ticket_id, member_id,
       coalesce({TICKET_CATEGORY_CASE}, ticket_type) as ticket_category,
       ticket_status, ticket_priority, ticket_channel,
       cast(cast(nullif(trim(csat_rating), '') as decimal(38,6)) as integer) as csat_rating,
       cast(created_at as date) as created_at,
       cast(nullif(resolved_at, '') as date) as resolved_at
from raw_tickets""", ("raw_tickets",))


def h_sql(*exprs: str, salt: str | None = None, seed: int = 42) -> str:
    """32-bit hash of the keys: first 8 hex digits of md5(keys joined by '|' || [':' salt] || ':' seed)."""
    text = "concat_ws('|', " + ", ".join(f"cast({e} as varchar)" for e in exprs) + ")"
    tail = (f":{salt}" if salt is not None else "") + f":{seed}"
    return f"('0x' || substr(md5({text} || '{tail}'), 1, 8))::bigint"


def weighted_sql(h: str, labels, cuts) -> str:
    """CASE chain picking the first label whose cut point exceeds the hash."""
    whens = " ".join(f"when {h} < {c} then {lab!r}" for lab, c in zip(labels[:-1], cuts[:-1]))
    return f"case {whens} else {labels[-1]!r} end"

cte("workouts", """
select workout_id, member_id, cast(activity_date as date) as activity_date,
       cast(steps as integer) as steps, cast(distance_km as decimal(18,2)) as distance_km,
       cast(very_active_minutes as integer) as very_active_minutes,
       cast(moderately_active_minutes as integer) as moderately_active_minutes,
       cast(light_active_minutes as integer) as light_active_minutes,
       cast(sedentary_minutes as integer) as sedentary_minutes,
       cast(calories_burned as integer) as calories_burned,
       source as data_source,
       coalesce(cast(very_active_minutes as integer) + cast(moderately_active_minutes as integer) >= 15, false)
         as is_active_day
from raw_workouts""", ("raw_workouts",))

cte("workout_streaks", """
select member_id, streak_start_date, streak_end_date, streak_length_days,
       cast(rank() over (partition by member_id order by streak_end_date desc) as bigint) as streak_recency_rank
from (
  select member_id, min(activity_date) as streak_start_date, max(activity_date) as streak_end_date,
         date_diff('day', min(activity_date), max(activity_date)) + 1 as streak_length_days
  from (
    select *, count(*) filter (where opens) over (partition by member_id order by activity_date) as island
    from (select member_id, activity_date,
                 coalesce(activity_date > lag(activity_date) over (partition by member_id order by activity_date) + 1, true) as opens
          from (select member_id, activity_date from workouts group by all having bool_or(is_active_day)) g) o) i
  group by member_id, island) b""", ("workouts",))

cte("workout_as_of", "select max(activity_date) as as_of_date from workouts", ("workouts",))
