"""Engagement and value per account type and plan tier (K15) and its parts.

The reference joins members to every subscription and then aggregates the
fanned-out rows.  Here the fan-out is folded first: subscriptions are
reduced to one row per (member, tier) carrying the row count ``n_subs``, and
every per-row measure becomes an ``n_subs``-weighted sum.  The results are
identical, including the parts that count subscription rows rather than
members (Q3), but no shuffle ever carries more than a few rows per member,
and a member with a huge number of subscriptions is reduced map-side.

Averages are exact decimal quotients rounded half away from zero once
(``sum / count`` on decimal(20,0) operands keeps 18 fractional digits).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import DAYS_PER_MONTH
from ..operators import streaks as sk

MONEY = "decimal(18,2)"
# sums of money: wide enough for totals over very large tables
MONEY_SUM = "decimal(38,2)"
ONE_PLACE = "decimal(18,1)"


def _dec(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def exact_avg(total: Column, count: Column, places: int, divisor: int = 1) -> Column:
    """round(total / (count * divisor), places), null when count is 0 or null."""
    den = count * F.lit(divisor)
    return F.when(count > 0, F.round(_dec(total) / _dec(den), places)).cast(f"decimal(18,{places})")


def money_per(total: Column, count: Column) -> Column:
    """round(total / count, 2) for a money total: the total is narrowed to
    decimal(28,2) first so the quotient keeps 12 fractional digits before the
    single rounding (decimal(38,2) / bigint would keep only 6)."""
    return F.round(total.cast("decimal(28,2)") / count, 2).cast(MONEY)


def member_order_rollup(orders: DataFrame) -> DataFrame:
    """A4: per member, number of one-time orders and their total (all statuses, Q4)."""
    return orders.groupBy("member_id").agg(
        F.count(F.lit(1)).alias("count_orders"),
        F.sum("amount").cast(MONEY_SUM).alias("total_orders_amount"),
    )


def member_tiers(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Subscriptions folded to (member_id, tier): row count and billed total.

    Folded per (member, plan) before the plan join, so what meets the few
    plan keys is one row per member and plan, not one per subscription.
    """
    per_plan = subscriptions.groupBy("member_id", "plan_id").agg(
        F.count(F.lit(1)).alias("n_subs"), F.sum("billed_amount").alias("billed"))
    return per_plan.join(plans.select("plan_id", "tier"), "plan_id", "inner").groupBy("member_id", "tier").agg(
        F.sum("n_subs").alias("n_subs"),
        F.sum("billed").alias("billed"),
    )


def subscribed_members(members: DataFrame, accounts: DataFrame, subscriptions: DataFrame,
                       plans: DataFrame) -> DataFrame:
    """J4 + J5 + A14: members that have a subscription, with their account type
    (null when the account is missing - that null forms its own group) and tier.

    One row per (member, tier) with the folded subscription rows.
    """
    m = members.select("member_id", "account_id", "join_date").join(
        accounts.select("account_id", "account_type"), "account_id", "left")
    return m.join(member_tiers(subscriptions, plans), "member_id", "inner")


def segment_counts(base: DataFrame) -> DataFrame:
    """Members and subscription rows per (account type, tier)."""
    return base.groupBy("account_type", "tier").agg(
        F.countDistinct("member_id").alias("count_members"),
        F.sum("n_subs").cast("bigint").alias("subscription_rows"),
    )


def value_per_member(base: DataFrame) -> DataFrame:
    """A6 + P15: distinct members, billed total over subscription rows, and their ratio."""
    g = base.groupBy("account_type", "tier").agg(
        F.countDistinct("member_id").alias("count_members"),
        F.sum("billed").cast(MONEY_SUM).alias("total_billed_amount"),
    )
    return g.withColumn(
        "rev_per_member",
        money_per(F.col("total_billed_amount"), F.col("count_members")))


def _conditional_aggs(rows: DataFrame) -> list[Column]:
    n = F.col("n_subs")
    cur = F.col("is_current") == 1
    return [
        F.sum(F.when(cur, n).otherwise(0)).cast("bigint").alias("count_mem_with_current_streak"),
        exact_avg(F.sum(F.when(cur, n * F.col("latest_streak_length"))),
                  F.sum(F.when(cur & F.col("latest_streak_length").isNotNull(), n)), 1
                  ).alias("avg_current_streak_length"),
        exact_avg(F.sum(n * F.col("longest_streak")),
                  F.sum(F.when(F.col("longest_streak").isNotNull(), n)), 1).alias("avg_longest_streak_days"),
        F.sum(n * F.col("count_orders")).cast("bigint").alias("count_orders"),
    ]


def _membership_aggs() -> list[Column]:
    n = F.col("n_subs")
    days = F.datediff(F.col("as_of_date"), F.col("join_date"))
    known = F.sum(F.when(days.isNotNull(), n))
    return [
        exact_avg(F.sum(n * days), known, 1).alias("avg_length_of_membership_days"),
        exact_avg(F.sum(n * days), known, 1, divisor=DAYS_PER_MONTH).alias("avg_length_of_membership_months"),
    ]


def with_member_facts(base: DataFrame, orders: DataFrame, streaks: DataFrame,
                      as_of: DataFrame) -> DataFrame:
    """J3 + J4: attach order counts, streak facts and the as-of date (a scalar subquery).

    Order and streak facts are one row per member and arrive hash-partitioned
    by member, so these joins share one partitioning.
    """
    facts = sk.streak_summary(streaks, as_of)
    return base.join(member_order_rollup(orders).select("member_id", "count_orders"), "member_id", "left") \
        .join(facts, "member_id", "left") \
        .withColumn("as_of_date", as_of.select("as_of_date").scalar())


def conditional_measures(base_with_facts: DataFrame) -> DataFrame:
    """A7 + A8 + A9 + A10 per (account type, tier)."""
    return base_with_facts.groupBy("account_type", "tier").agg(*_conditional_aggs(base_with_facts))


def membership_length(base: DataFrame, as_of: DataFrame) -> DataFrame:
    """A11 + P19: average membership length in days and in 30-day months (rounded once, Q9)."""
    rows = base.withColumn("as_of_date", as_of.select("as_of_date").scalar())
    return rows.groupBy("account_type", "tier").agg(*_membership_aggs())


def engagement_and_value(members: DataFrame, accounts: DataFrame, subscriptions: DataFrame,
                         plans: DataFrame, orders: DataFrame, activity: DataFrame,
                         streaks: DataFrame | None = None) -> DataFrame:
    """Engagement and value KPIs per account type and plan tier.

    ``activity`` supplies the global as-of date (its newest day, Q8) and, when
    ``streaks`` is not given, the streaks themselves.  Counts of members with
    a current streak and of orders are over subscription rows, not distinct
    members, exactly as in the reference (Q3); orders of every status count
    and subscriptions are not filtered by status (Q4).
    """
    as_of = sk.as_of_date(activity)
    if streaks is None:
        streaks = sk.member_streaks(activity)
    base = subscribed_members(members, accounts, subscriptions, plans)
    rows = with_member_facts(base, orders, streaks, as_of)
    g = rows.groupBy("account_type", "tier").agg(
        F.countDistinct("member_id").alias("count_members"),
        F.sum("billed").cast(MONEY_SUM).alias("total_billed_amount"),
        *_conditional_aggs(rows),
        *_membership_aggs(),
    )
    return g.select(
        "account_type", "tier", "count_members", "total_billed_amount",
        money_per(F.col("total_billed_amount"), F.col("count_members")).alias("rev_per_member"),
        "count_mem_with_current_streak", "avg_current_streak_length", "avg_longest_streak_days",
        "count_orders", "avg_length_of_membership_days", "avg_length_of_membership_months",
    )
