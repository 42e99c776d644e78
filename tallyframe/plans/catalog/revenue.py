"""Revenue (K11-K14) and engagement (K15) queries on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import streaks as sk
from ...sources import testdata as td
from .. import engagement as eg
from .. import revenue as rv
from .. import staging as st
from ..oracle_base import avg_one_place, ratio_money_by_count, ratio_money_by_money, sql
from . import common as c
from .registry import register

ATTRIBUTED_SQL = """
select a.campaign_id, sum(s.billed_amount) as mrr, count(distinct s.subscription_id) as n
from subscriptions s
join members m on m.member_id = s.member_id
join acquisition a on a.account_id = m.account_id
where s.status = 'active'
group by a.campaign_id"""

DEFAULTS_SQL = f"""
select cp.campaign_id, cp.campaign_name, cp.channel, cp.target_audience, cp.spend, cp.conversions,
       cast(coalesce(t.mrr, 0) as decimal(38,2)) as attributed_mrr,
       cast(coalesce(t.n, 0) as bigint) as attributed_subscriptions
from campaigns cp left join ({ATTRIBUTED_SQL}) t on t.campaign_id = cp.campaign_id"""

RATIOS_SQL = f"""
select *,
       case when attributed_subscriptions > 0
            then {ratio_money_by_count('spend', 'attributed_subscriptions')} end as spend_per_attributed_subscription,
       case when attributed_mrr > 0
            then {ratio_money_by_money('spend', 'attributed_mrr')} end as payback_period_months
from ({DEFAULTS_SQL}) x"""

REV_DEPS = ("subscriptions", "members", "acquisition", "campaigns")


def _attributed(spark, d):
    return rv.attributed_revenue(c.subscriptions(spark, d), c.members(spark, d), c.acquisition(spark, d))


@register("attributed_revenue", sql(f"""
select campaign_id, cast(mrr as decimal(38,2)) as attributed_mrr, n as attributed_subscriptions
from ({ATTRIBUTED_SQL}) t""", *REV_DEPS))
def attributed_revenue(spark, d):
    return _attributed(spark, d)


@register("unmatched_defaults", sql(DEFAULTS_SQL, *REV_DEPS))
def unmatched_defaults(spark, d):
    return rv.campaigns_with_revenue(c.campaigns(spark, d), _attributed(spark, d))


@register("guarded_ratio", sql(f"""
select campaign_id, spend_per_attributed_subscription, payback_period_months from ({RATIOS_SQL}) r""", *REV_DEPS))
def guarded_ratio(spark, d):
    return rv.campaign_ratios(rv.campaigns_with_revenue(c.campaigns(spark, d), _attributed(spark, d))).select(
        "campaign_id", "spend_per_attributed_subscription", "payback_period_months")


@register("revenue_by_campaign", sql(f"select * from ({RATIOS_SQL}) r order by attributed_mrr desc, campaign_id",
                                     *REV_DEPS))
def revenue_by_campaign(spark, d):
    return rv.revenue_by_campaign(c.subscriptions(spark, d), c.members(spark, d), c.acquisition(spark, d),
                                  c.campaigns(spark, d))


SEGMENT_SQL = """
select a.account_type, p.plan_name, cast(sum(s.billed_amount) as decimal(38,2)) as active_mrr,
       count(distinct s.subscription_id) as active_subscriptions
from subscriptions s
join members m on m.member_id = s.member_id
join accounts a on a.account_id = m.account_id
join plans p on p.plan_id = s.plan_id
where s.status = 'active'
group by a.account_type, p.plan_name"""


@register("revenue_by_segment", sql(SEGMENT_SQL, "subscriptions", "members", "accounts", "plans"))
def revenue_by_segment(spark, d):
    return rv.revenue_by_segment(c.subscriptions(spark, d), c.members(spark, d), c.accounts(spark, d),
                                 c.plans(spark, d))


MONTHLY_SQL = """
with spine as (
  select cast(unnest(generate_series(
           date_trunc('month', (select min(start_date) from subscriptions)),
           date_trunc('month', date '2001-12-31'), interval 1 month)) as date) as month_start),
live as (
  select sp.month_start, sum(s.billed_amount) as mrr, count(*) as n
  from spine sp join subscriptions s
    on date_trunc('month', s.start_date) <= sp.month_start
   and (s.end_date is null or date_trunc('month', s.end_date) >= sp.month_start)
  group by sp.month_start),
one_time as (
  select cast(date_trunc('month', order_date) as date) as m, sum(amount) as amt
  from one_time_orders group by 1)
select sp.month_start,
       cast(coalesce(live.mrr, 0) as decimal(38,2)) as mrr,
       cast(coalesce(live.n, 0) as bigint) as active_subscriptions,
       cast(coalesce(one_time.amt, 0) as decimal(38,2)) as one_time_revenue
from spine sp
left join live on live.month_start = sp.month_start
left join one_time on one_time.m = sp.month_start"""


def _monthly(spark, d):
    return rv.monthly_revenue(c.subscriptions(spark, d), c.orders(spark, d), td.ORDERS_AS_OF)


@register("monthly_revenue", sql(f"select * from ({MONTHLY_SQL}) q", "subscriptions", "one_time_orders"))
def monthly_revenue(spark, d):
    return _monthly(spark, d)


# the same subscriptions with every 17th start missing and every 13th ending before it starts
IMPERFECT_SQL = """
select * replace (case when cast(subscription_id as bigint) % 17 = 0 then null else start_date end as start_date,
                  case when cast(subscription_id as bigint) % 13 = 0 then start_date - 70 else end_date end as end_date)
from subscriptions"""


@register("monthly_revenue_imperfect_dates", sql(
    f"""select * from (with subscriptions_i as ({IMPERFECT_SQL})
    {MONTHLY_SQL.replace("with spine as", ", spine as").replace("from subscriptions)", "from subscriptions_i)").replace("join subscriptions s", "join subscriptions_i s")}) q""",
    "subscriptions", "one_time_orders"))
def monthly_revenue_imperfect_dates(spark, d):
    number = F.col("subscription_id").cast("bigint")
    subs = c.subscriptions(spark, d).withColumns({
        "end_date": F.when(number % 13 == 0, F.date_sub("start_date", 70)).otherwise(F.col("end_date")),
        "start_date": F.when(number % 17 != 0, F.col("start_date"))})
    return rv.monthly_revenue(subs, c.orders(spark, d), td.ORDERS_AS_OF)


# subscription ids that occur under two members and under two plans
SHARED_SQL = """
select * from subscriptions
union all
select * replace (cast(cast(member_id as bigint) + 1 as varchar) as member_id) from subscriptions
where cast(subscription_id as bigint) % 11 = 0
union all
select * replace ((select min(plan_id) from plans) as plan_id) from subscriptions
where cast(subscription_id as bigint) % 7 = 0"""


def _shared(spark, d):
    subs, plans = c.subscriptions(spark, d), c.plans(spark, d)
    number = F.col("subscription_id").cast("bigint")
    moved = subs.filter(number % 11 == 0).withColumn("member_id", (F.col("member_id").cast("bigint") + 1).cast(subs.schema["member_id"].dataType))
    planned = subs.filter(number % 7 == 0).withColumn("plan_id", plans.agg(F.min("plan_id")).scalar())
    return subs.unionByName(moved).unionByName(planned)


@register("attributed_revenue_shared_ids", sql(f"""
select * from (with subscriptions_s as ({SHARED_SQL})
select campaign_id, cast(mrr as decimal(38,2)) as attributed_mrr, n as attributed_subscriptions
from ({ATTRIBUTED_SQL.replace("from subscriptions s", "from subscriptions_s s")}) t) q""", "plans", *REV_DEPS))
def attributed_revenue_shared_ids(spark, d):
    return rv.attributed_revenue(_shared(spark, d), c.members(spark, d), c.acquisition(spark, d))


@register("revenue_by_segment_shared_ids", sql(f"""
select * from (with subscriptions_s as ({SHARED_SQL})
{SEGMENT_SQL.replace("from subscriptions s", "from subscriptions_s s")}) q""", "subscriptions", "members", "accounts", "plans"))
def revenue_by_segment_shared_ids(spark, d):
    return rv.revenue_by_segment(_shared(spark, d), c.members(spark, d), c.accounts(spark, d), c.plans(spark, d))


@register("revenue_trend", sql(f"select * from ({MONTHLY_SQL}) q", "subscriptions", "one_time_orders"))
def revenue_trend(spark, d):
    return rv.revenue_trend(_monthly(spark, d))


@register("month_spine", sql("""
select cast(unnest(generate_series(date_trunc('month', (select min(start_date) from subscriptions)),
                                   date_trunc('month', date '2001-12-31'), interval 1 month)) as date) as month_start
""", "subscriptions"))
def month_spine(spark, d):
    first = c.subscriptions(spark, d).agg(F.min("start_date").alias("s"))
    return rv.month_spine(F.col("s"), F.lit(td.ORDERS_AS_OF), first)


# --------------------------------------------------------------------------- engagement

# One row per subscription (the fan-out the KPIs are defined on), with the
# member's facts attached: streak facts from one per-member aggregate over the
# streaks, one-time order counts, and the membership length in days.
ENGAGEMENT_ROWS = """
with streak_facts as (
  select st.member_id,
         max(st.streak_length_days) as longest_streak,
         max(st.streak_length_days) filter (where st.streak_recency_rank = 1) as streak_length_days,
         max(case when st.streak_recency_rank = 1 and st.streak_end_date = (select as_of_date from as_of)
                  then 1 else 0 end) as is_current
  from streaks st
  group by st.member_id),
order_counts as (select member_id, count(*) as count_orders from one_time_orders group by member_id)
select acc.account_type, pl.tier, mem.member_id, sub.billed_amount, sf.is_current, sf.streak_length_days,
       sf.longest_streak, oc.count_orders, (select as_of_date from as_of) - mem.join_date as member_days
from subscriptions sub
join members mem on mem.member_id = sub.member_id
join plans pl on pl.plan_id = sub.plan_id
left join accounts acc on acc.account_id = mem.account_id
left join streak_facts sf on sf.member_id = mem.member_id
left join order_counts oc on oc.member_id = mem.member_id"""

ENG_DEPS = ("streaks", "as_of", "one_time_orders", "members", "accounts", "subscriptions", "plans")

CUR_LEN = "case when is_current = 1 then streak_length_days end"
M_VALUE = f"""
count(distinct member_id) as count_members,
cast(sum(billed_amount) as decimal(38,2)) as total_billed_amount,
{ratio_money_by_count('sum(billed_amount)', 'count(distinct member_id)')} as rev_per_member"""
M_COND = f"""
count(case when is_current = 1 then member_id end) as count_mem_with_current_streak,
{avg_one_place(f'sum({CUR_LEN})', f'count({CUR_LEN})')} as avg_current_streak_length,
{avg_one_place('sum(longest_streak)', 'count(longest_streak)')} as avg_longest_streak_days,
cast(sum(count_orders) as bigint) as count_orders"""
M_LEN = f"""
{avg_one_place('sum(member_days)', 'count(member_days)')} as avg_length_of_membership_days,
{avg_one_place('sum(member_days)', 'count(member_days)', 30)} as avg_length_of_membership_months"""


def _base(spark, d):
    return eg.subscribed_members(c.members(spark, d), c.accounts(spark, d), c.subscriptions(spark, d),
                                 c.plans(spark, d))


def _streaks(spark, d):
    return sk.member_streaks(c.activity(spark, d), already_daily=True)


@register("member_order_rollup", sql("""
select member_id, count(*) as count_orders, cast(sum(amount) as decimal(38,2)) as total_orders_amount
from one_time_orders group by member_id""", "one_time_orders"))
def member_order_rollup(spark, d):
    return eg.member_order_rollup(c.orders(spark, d))


@register("subscribed_members", sql(f"""
select account_type, tier, count(distinct member_id) as count_members, count(*) as subscription_rows
from ({ENGAGEMENT_ROWS}) r group by account_type, tier""", *ENG_DEPS))
def subscribed_members(spark, d):
    return eg.segment_counts(_base(spark, d))


@register("value_per_member", sql(f"""
select account_type, tier, {M_VALUE} from ({ENGAGEMENT_ROWS}) r group by account_type, tier""", *ENG_DEPS))
def value_per_member(spark, d):
    return eg.value_per_member(_base(spark, d))


@register("conditional_measures", sql(f"""
select account_type, tier, {M_COND} from ({ENGAGEMENT_ROWS}) r group by account_type, tier""", *ENG_DEPS))
def conditional_measures(spark, d):
    act = c.activity(spark, d)
    rows = eg.with_member_facts(_base(spark, d), c.orders(spark, d), _streaks(spark, d), sk.as_of_date(act))
    return eg.conditional_measures(rows)


@register("membership_length", sql(f"""
select account_type, tier, {M_LEN} from ({ENGAGEMENT_ROWS}) r group by account_type, tier""", *ENG_DEPS))
def membership_length(spark, d):
    return eg.membership_length(_base(spark, d), sk.as_of_date(c.activity(spark, d)))


@register("engagement_and_value", sql(f"""
select account_type, tier, {M_VALUE}, {M_COND}, {M_LEN}
from ({ENGAGEMENT_ROWS}) r group by account_type, tier""", *ENG_DEPS))
def engagement_and_value(spark, d):
    act = c.activity(spark, d)
    return eg.engagement_and_value(c.members(spark, d), c.accounts(spark, d), c.subscriptions(spark, d),
                                   c.plans(spark, d), c.orders(spark, d), act,
                                   streaks=_streaks(spark, d))


WORKOUT_ROWS = ENGAGEMENT_ROWS.replace("from streaks st", "from workout_streaks st").replace("from as_of", "from workout_as_of")


@register("engagement_over_workouts", sql(f"""
select account_type, tier, {M_VALUE}, {M_COND}, {M_LEN}
from ({WORKOUT_ROWS}) r group by account_type, tier""", "workout_streaks", "workout_as_of", *ENG_DEPS[2:]))
def engagement_over_workouts(spark, d):
    """K5 -> K10 -> K15 as in the reference: as-of day and streaks from staged workouts (15-minute rule)."""
    workouts = st.stage_workouts(td.raw_workouts(spark, d), money=td.MONEY)
    return eg.engagement_and_value(c.members(spark, d), c.accounts(spark, d), c.subscriptions(spark, d),
                                   c.plans(spark, d), c.orders(spark, d), workouts)
