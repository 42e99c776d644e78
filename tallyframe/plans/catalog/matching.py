"""Matching, attribution and calendar queries on the test tables.

Accounts for matching are members (customers): type = their nation key as
text, acquisition date = first order day.  Campaigns target a nation.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import calendar as cal
from ...operators import matching as mt
from ...operators import streaks as sk
from ...sources import testdata as td
from ..backfill import activity_backfill
from ..oracle_base import h_sql, sql
from . import common as c
from .registry import register

ELIGIBLE_SQL = """
select m.member_id as account_id, cp.campaign_id, m.join_date as acquisition_date
from members m join campaigns cp
  on m.account_id = cp.target_audience
 and m.join_date between cp.start_date and cp.end_date + 45"""

# the campaign whose place among the eligible ones (by id) is the account's hash modulo their count
CHOSEN_SQL = f"""
select account_id, campaign_id from (
  select *, row_number() over (partition by account_id order by campaign_id) as rn,
         count(*) over (partition by account_id) as n
  from ({ELIGIBLE_SQL}) e) x
where rn = {h_sql('account_id', salt='choice')} % n + 1"""


def accounts(spark, d):
    return c.members(spark, d).select(
        F.col("member_id").alias("account_id"), F.col("account_id").alias("account_type"),
        F.col("join_date").alias("acquisition_date"))


def _pairs(spark, d):
    return mt.window_matches(accounts(spark, d), c.campaigns(spark, d), entity_key="account_id",
                             entity_type="account_type", entity_date="acquisition_date",
                             campaign_key="campaign_id")


@register("acquisition_date", sql("""
select member_id, min(start_date) as acquisition_date from subscriptions group by member_id""", "subscriptions"))
def acquisition_date(spark, d):
    return mt.earliest_date(c.subscriptions(spark, d), "member_id", "start_date")


@register("eligible_matches", sql(ELIGIBLE_SQL, "members", "campaigns"))
def eligible_matches(spark, d):
    return _pairs(spark, d)


@register("chosen_match", sql(CHOSEN_SQL, "members", "campaigns"))
def chosen_match(spark, d):
    return mt.choose_match(accounts(spark, d), c.campaigns(spark, d), entity_key="account_id", entity_type="account_type",
                           entity_date="acquisition_date", campaign_key="campaign_id", seed=td.SEED)


@register("attributed_accounts", sql(f"""
select account_id, campaign_id from (
  select *, row_number() over (order by {h_sql('account_id', salt='order')}, account_id) as rn
  from ({CHOSEN_SQL}) ch) r
where rn <= (select floor(0.55 * count(*)) from members where join_date is not null)""", "members", "campaigns"))
def attributed_accounts(spark, d):
    return mt.attribute_accounts(accounts(spark, d), c.campaigns(spark, d), fraction="0.55", seed=td.SEED)


@register("accounts_with_activity", """
select c_custkey, c_name from customer where exists (select 1 from events where user_id = c_custkey)""")
def accounts_with_activity(spark, d):
    return mt.with_match(td.table(spark, d, "customer").select("c_custkey", "c_name"),
                         td.table(spark, d, "events"), "c_custkey", "user_id")


# --------------------------------------------------------------------------- calendar and sequences

AS_OF = "(select as_of_date from as_of)"

SPINE_SQL = f"""
select u.member_id,
       cast(unnest(generate_series(greatest(coalesce(u.join_date, {AS_OF} - 59), {AS_OF} - 59),
                                   {AS_OF}, interval 1 day)) as date) as activity_date
from (select member_id, min(activity_date) as join_date from activity group by member_id) u
where greatest(coalesce(u.join_date, {AS_OF} - 59), {AS_OF} - 59) <= {AS_OF}"""


def _spine(spark, d):
    act = c.activity(spark, d)
    users = act.groupBy("member_id").agg(F.min("activity_date").alias("join_date"))
    when = sk.as_of_date(act).scalar()
    return cal.entity_day_spine(users, "member_id", "join_date", when, 60)


@register("entity_day_spine", sql(SPINE_SQL, "activity", "as_of"))
def entity_day_spine(spark, d):
    return _spine(spark, d)


@register("reanchor_sequence", sql(f"""
select member_id, original_date, activity_date from (
  select act.member_id, act.activity_date as original_date, m.join_date,
         {AS_OF} + cast(row_number() over (partition by act.member_id order by act.activity_date)
                        - count(*) over (partition by act.member_id) as integer) as activity_date
  from activity act left join members m on m.member_id = act.member_id) r
where join_date is null or activity_date >= join_date""", "activity", "members", "as_of"))
def reanchor_sequence(spark, d):
    act = c.activity(spark, d)
    rows = act.select("member_id", F.col("activity_date").alias("original_date")) \
        .join(c.members(spark, d).select("member_id", "join_date"), "member_id", "left")
    return cal.reanchor(rows, "member_id", "original_date", sk.as_of_date(act).scalar(), join_col="join_date") \
        .select("member_id", "original_date", "activity_date")


def _factor(keys, measure):
    return f"(cast(10000 + {h_sql(*keys, salt=measure)} % 3001 - 1500 as decimal(10,0)) * 0.0001)"


def _bootstrap_sql(spine: str, pool: str) -> str:
    keys = ("s.member_id", "s.activity_date")
    return f"""
select s.member_id, s.activity_date,
       cast(greatest(round(cast(p.steps as decimal(20,2)) * {_factor(keys, 'steps')}, 0), 0) as bigint) as steps,
       cast(round(cast(p.value_sum as decimal(20,2)) * {_factor(keys, 'value_sum')}, 2) as decimal(18,2))
         as value_sum
from ({spine}) s
join (select steps, value_sum,
             row_number() over (order by {h_sql('member_id', 'activity_date', salt='pool')},
                                member_id, activity_date) as pick
      from ({pool}) q) p
  on p.pick = {h_sql(*keys, salt='pick')} % (select count(*) from ({pool}) q) + 1"""


@register("bootstrap_resample", sql(_bootstrap_sql(SPINE_SQL, "select * from activity"), "activity", "as_of"))
def bootstrap_resample(spark, d):
    pool = c.activity(spark, d).select("member_id", "activity_date", "steps", "value_sum")
    return cal.bootstrap(_spine(spark, d), ["member_id", "activity_date"], pool, ["member_id", "activity_date"],
                         {"steps": "int", "value_sum": "decimal"}, td.SEED)


BACKFILL_SQL = f"""
with real as (
  select act.member_id, act.activity_date, act.steps, act.value_sum, m.join_date
  from activity act join members m on m.member_id = act.member_id where m.is_fitbit_seed),
shifted as (
  select member_id, join_date, steps, value_sum,
         {AS_OF} + cast(row_number() over (partition by member_id order by activity_date)
                        - count(*) over (partition by member_id) as integer) as activity_date
  from real),
spine as (
  select o.member_id,
         cast(unnest(generate_series(greatest(coalesce(o.join_date, {AS_OF} - 59), {AS_OF} - 59),
                                     {AS_OF}, interval 1 day)) as date) as activity_date
  from members o
  where not o.is_fitbit_seed
    and greatest(coalesce(o.join_date, {AS_OF} - 59), {AS_OF} - 59) <= {AS_OF}),
both_parts as (
  select member_id, activity_date, cast(steps as bigint) as steps, cast(value_sum as decimal(18,2)) as value_sum,
         'real_fitbit' as data_source
  from shifted where join_date is null or activity_date >= join_date
  union all
  select *, 'synthetic' as data_source
  from ({_bootstrap_sql('select * from spine', 'select member_id, activity_date, steps, value_sum from real')}) b)
select printf('wkt_%07d', row_number() over (order by {h_sql('member_id', 'activity_date', salt='workout')},
                                             member_id, activity_date)) as workout_id,
       member_id, activity_date, steps, value_sum, data_source
from both_parts"""


@register("activity_backfill", sql(f"select * from ({BACKFILL_SQL}) q", "activity", "members", "as_of"))
def activity_backfill_query(spark, d):
    act = c.activity(spark, d)
    return activity_backfill(c.members(spark, d), act.select("member_id", "activity_date", "steps", "value_sum"),
                             sk.as_of_date(act), seed=td.SEED)
