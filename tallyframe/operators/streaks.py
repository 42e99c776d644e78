"""Unbroken activity streaks (gaps and islands) and streak summaries.

Input is any frame with an entity column, a date column and an activity
flag.  Plan shape (checked in tests):

* the input is first reduced to one row per (entity, day) with a map-side
  combined aggregate, so a duplicated day cannot split a run and a hot entity
  costs at most one row per day per task before the shuffle;
* ``row_number`` over the entity's active days, subtracted from the date,
  gives a run key that is constant inside a run (W1);
* the run aggregate (A2) and the recency rank (W2) reuse the entity hash
  partitioning of the window, so after the day grain there is exactly one
  exchange.

A window partition holds one entity's active days, which is bounded by the
number of calendar days in the data, not by the entity's event count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import days_between, flag01


def day_grain(df: DataFrame, entity: str = "member_id", day: str = "activity_date",
              flag: str = "is_active_day") -> DataFrame:
    """One row per (entity, day); the day is active if any of its rows is (Q7)."""
    return df.groupBy(entity, day).agg(F.bool_or(F.col(flag)).alias(flag))


def run_keys(days: DataFrame, entity: str = "member_id", day: str = "activity_date",
             flag: str = "is_active_day") -> DataFrame:
    """W1 + P12 + P17: active days with ``run_key = day - row_number``.

    The flag filter is applied before the window (legal, since the flag is a
    partition key of the row number, and Catalyst would not push it itself).
    Rows without a date are numbered last, have no run key, and so make one
    run without dates.
    """
    w = Window.partitionBy(entity).orderBy(F.col(day).asc_nulls_last())
    active = days.filter(F.col(flag)).select(entity, day)
    return active.withColumn("run_key", F.date_sub(F.col(day), F.row_number().over(w)))


def run_bounds(keyed: DataFrame, entity: str = "member_id", day: str = "activity_date") -> DataFrame:
    """A2: one row per run with its first day, last day and length."""
    return keyed.groupBy(entity, "run_key").agg(
        F.min(day).alias("streak_start_date"),
        F.max(day).alias("streak_end_date"),
        F.count(F.lit(1)).alias("streak_length_days"),
    )


def recency_rank(runs: DataFrame, entity: str = "member_id") -> DataFrame:
    """The run that ends last gets rank 1; a run without dates comes before all others, as in the
    reference's database, where a descending order puts nulls first."""
    w = Window.partitionBy(entity).orderBy(F.col("streak_end_date").desc_nulls_first())
    return runs.withColumn("streak_recency_rank", F.row_number().over(w).cast("bigint"))


def member_streaks(activity: DataFrame, entity: str = "member_id", day: str = "activity_date",
                   flag: str = "is_active_day", already_daily: bool = False) -> DataFrame:
    """One row per unbroken run of active days.

    Output: entity, streak_start_date, streak_end_date, streak_length_days,
    streak_recency_rank.  Pass ``already_daily=True`` when the input is known
    to hold one row per (entity, day) to skip the dedupe aggregate.
    """
    days = activity.select(entity, day, flag) if already_daily else day_grain(activity, entity, day, flag)
    runs = run_bounds(run_keys(days, entity, day, flag), entity, day)
    return recency_rank(runs, entity).select(
        entity, "streak_start_date", "streak_end_date", "streak_length_days", "streak_recency_rank")


def longest_streak(streaks: DataFrame, entity: str = "member_id") -> DataFrame:
    """A3: longest run per entity."""
    return streaks.groupBy(entity).agg(F.max("streak_length_days").alias("longest_streak"))


def as_of_date(activity: DataFrame, day: str = "activity_date") -> DataFrame:
    """A1: one-row frame with the newest day of the whole table (Q8)."""
    return activity.agg(F.max(day).alias("as_of_date"))


def latest_streak_status(streaks: DataFrame, as_of: DataFrame, entity: str = "member_id") -> DataFrame:
    """O2 + J3 + P16 + P20: each entity's latest run and whether it is current.

    "Current" means the run ends on the newest day of the whole table, not of
    the entity (kept as in the reference).  ``as_of`` has exactly one row; it
    is read as a scalar subquery (computed once, inlined as a value).
    """
    latest = streaks.filter(F.col("streak_recency_rank") == 1)
    days_since = days_between(as_of.select("as_of_date").scalar(), "streak_end_date")
    return latest.select(
        entity,
        "streak_length_days",
        days_since.alias("days_since_streak_end"),
        flag01(days_since == 0).alias("is_current"),
    )


def streak_summary(streaks: DataFrame, as_of: DataFrame, entity: str = "member_id") -> DataFrame:
    """Per entity in one aggregate: longest run, latest run length and currency.

    Equivalent to joining :func:`longest_streak` with
    :func:`latest_streak_status`; it reuses the entity partitioning of the
    streak frame, so no extra exchange is needed.
    """
    agg = streaks.groupBy(entity).agg(
        F.max("streak_length_days").alias("longest_streak"),
        F.max(F.when(F.col("streak_recency_rank") == 1, F.col("streak_length_days"))).alias("latest_streak_length"),
        F.max(F.when(F.col("streak_recency_rank") == 1, F.col("streak_end_date"))).alias("latest_streak_end"),
    )
    cur: Column = F.col("latest_streak_end") == as_of.select("as_of_date").scalar()
    return agg.select(
        entity, "longest_streak", "latest_streak_length", flag01(cur).alias("is_current"),
    )
