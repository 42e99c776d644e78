"""Streak queries (K10 and its parts) on the events activity days."""

from __future__ import annotations

from ...operators import streaks as sk
from ...sources import testdata as td
from .. import staging as st
from ..oracle_base import sql
from .registry import register


def streaks_of(spark, d):
    return sk.member_streaks(td.activity_days(spark, d), already_daily=True)


# runs told without numbering days: a day starts a run when the day before it is not active; the n-th active day
# of a member has run key day - n, and n counts the starts of the run and the days since
RUNS = """
day as (select member_id, activity_date as d, lag(activity_date) over w as before from activity where is_active_day
        window w as (partition by member_id order by activity_date)),
run as (select member_id, d, sum(case when before is null or d - before > 1 then 1 else 0 end)
               over (partition by member_id order by d) as run_no from day),
bound as (select member_id, run_no, min(d) as first_day, max(d) as last_day, max(d) - min(d) + 1 as days from run group by member_id, run_no),
keyed as (select b.*, cast(b.first_day - cast((select coalesce(sum(e.days), 0) from bound e
                                               where e.member_id = b.member_id and e.run_no < b.run_no) as integer) - 1 as date) as run_key
          from bound b)"""


def runs_sql(body: str) -> str:
    return sql(f"select * from (with {RUNS.strip()} {body}) q", "activity")


@register("run_key", runs_sql("""
select run.member_id, run.d as activity_date, keyed.run_key
from run join keyed on keyed.member_id = run.member_id and keyed.run_no = run.run_no"""))
def run_key(spark, d):
    return sk.run_keys(td.activity_days(spark, d))


@register("run_bounds", runs_sql("""
select member_id, run_key, first_day as streak_start_date, last_day as streak_end_date,
       cast(days as bigint) as streak_length_days from keyed"""))
def run_bounds(spark, d):
    return sk.run_bounds(sk.run_keys(td.activity_days(spark, d)))


@register("recency_rank", runs_sql("""
select k.member_id, k.run_key, k.first_day as streak_start_date, k.last_day as streak_end_date,
       cast(k.days as bigint) as streak_length_days,
       (select count(*) from keyed later where later.member_id = k.member_id and later.last_day >= k.last_day) as streak_recency_rank
from keyed k"""))
def recency_rank(spark, d):
    return sk.recency_rank(sk.run_bounds(sk.run_keys(td.activity_days(spark, d))))


@register("member_streaks", sql("select * from streaks", "streaks"))
def member_streaks(spark, d):
    return streaks_of(spark, d)


@register("longest_streak", sql("""
select member_id, max(streak_length_days) as longest_streak from streaks group by member_id""", "streaks"))
def longest_streak(spark, d):
    return sk.longest_streak(streaks_of(spark, d))


@register("latest_streak_status", sql("""
select s.member_id, s.streak_length_days,
       cast((select as_of_date from as_of) - s.streak_end_date as bigint) as days_since_streak_end,
       case when (select as_of_date from as_of) - s.streak_end_date = 0 then 1 else 0 end as is_current
from streaks s
where s.streak_recency_rank = 1""", "streaks", "as_of"))
def latest_streak_status(spark, d):
    act = td.activity_days(spark, d)
    return sk.latest_streak_status(sk.member_streaks(act, already_daily=True), sk.as_of_date(act))


@register("streak_summary", sql("""
select s.member_id, max(streak_length_days) as longest_streak,
       arg_max(streak_length_days, streak_end_date) as latest_streak_length,
       case when max(streak_end_date) = (select as_of_date from as_of) then 1 else 0 end as is_current
from streaks s group by s.member_id""", "streaks", "as_of"))
def streak_summary(spark, d):
    act = td.activity_days(spark, d)
    return sk.streak_summary(sk.member_streaks(act, already_daily=True), sk.as_of_date(act))



@register("workout_streaks", sql("select * from workout_streaks", "workout_streaks"))
def workout_streaks(spark, d):
    """K5 -> K10 as in the reference: streaks over staged workouts (15-minute rule)."""
    return sk.member_streaks(st.stage_workouts(td.raw_workouts(spark, d), money=td.MONEY))
