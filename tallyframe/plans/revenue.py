"""Revenue models: by campaign (K14), by segment (K13), by month.

K11-K13 have names and descriptions but no SQL in the reference; the rules
used here are stated in each docstring.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import default_zero, guarded_ratio
from ..operators.joins import HOT_KEY_ROWS, lookup_join

MONEY = "decimal(18,2)"
# sums of money: wide enough for totals over very large tables
MONEY_SUM = "decimal(38,2)"


def member_campaigns(members: DataFrame, acquisition: DataFrame, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """member_id -> campaign_id through the member's account (J1, second half).

    A :func:`~tallyframe.operators.joins.lookup_join`: the acquisition side is
    broadcast if it measures small enough; otherwise the members of a large
    employer are dealt over several tasks.
    """
    return lookup_join(members.select("member_id", "account_id"), acquisition.select("account_id", "campaign_id"),
                       "account_id", "inner", hot_rows).select("member_id", "campaign_id")


def holdings(subscriptions: DataFrame, holder: list[str]) -> DataFrame:
    """Subscriptions folded per holder as far as exact distinct counts allow.

    One grouping by (subscription_id, holder) serves sums and ownership.  Per
    id it tells the range of its holders and the billed total: an id under
    one holder only (all of them, where the id is a key) adds its total and
    one subscription to that holder's row.  An id under several holders stays
    a row per holder, so that it can be counted once per group.  Rows without
    an id add money only; they are kept apart by holder, so they meet in no
    one task.

    Returns rows (*holder, subscription_id, __billed, __ids): a folded row has
    no id and the number of ids in it, any other has its id and no number.
    """
    where = F.struct(*[F.col(c) for c in holder])
    base = subscriptions.groupBy("subscription_id", *holder).agg(F.sum("billed_amount").alias("__b"))
    own = base.groupBy("subscription_id", F.when(F.col("subscription_id").isNull(), where).alias("__of")).agg(
        F.min(where).alias("__least"), F.max(where).alias("__most"), F.sum("__b").alias("__b"))
    alone = F.col("__least").eqNullSafe(F.col("__most"))
    single = own.filter(alone).groupBy(*[F.col("__least")[c].alias(c) for c in holder]).agg(
        F.sum("__b").alias("__billed"), F.count("subscription_id").alias("__ids"))
    shared = base.join(own.filter(~alone).select("subscription_id"), "subscription_id", "left_semi")
    no_id = F.lit(None).cast(subscriptions.schema["subscription_id"].dataType)
    return single.select(*holder, no_id.alias("subscription_id"), "__billed", "__ids").unionByName(
        shared.select(*holder, "subscription_id", F.col("__b").alias("__billed"), F.lit(0).cast("bigint").alias("__ids")))


def grouped_revenue(held: DataFrame, by: list[str], revenue: str, ids: str) -> DataFrame:
    """Per group: billed amounts times the join multiplicity ``__k``, and the exact count of distinct ids.

    ``held`` are rows of :func:`holdings` joined to their groups, each (holder, group) once.
    """
    per_id = held.groupBy(*by, "subscription_id").agg(
        F.sum(F.col("__billed") * F.col("__k")).cast(MONEY_SUM).alias("__revenue"), F.sum("__ids").alias("__n"))
    return per_id.groupBy(*by).agg(F.sum("__revenue").cast(MONEY_SUM).alias(revenue),
                                   (F.sum("__n") + F.count("subscription_id")).cast("bigint").alias(ids))


def attributed_revenue(subscriptions: DataFrame, members: DataFrame, acquisition: DataFrame,
                       status: str | None = "active") -> DataFrame:
    """J1 + A5: per campaign, summed billed amount and distinct subscriptions.

    Subscriptions are folded per member first (:func:`holdings`), so a member
    holding a third of all subscriptions joins as one row; the member ->
    campaign pairs carry their join multiplicity ``__k``.  Per campaign:

    * attributed_mrr = sum(billed total x k): the sum is multiplied by any
      fan-out of the member/acquisition join, as in the reference (Q6);
    * attributed_subscriptions = count of distinct subscription ids over the
      joined rows, whether or not the id is a key.
    """
    subs = subscriptions
    if status is not None:
        subs = subs.filter(F.col("status") == status)
    pairs = member_campaigns(members, acquisition).groupBy("member_id", "campaign_id") \
        .agg(F.count(F.lit(1)).alias("__k"))
    return grouped_revenue(holdings(subs, ["member_id"]).join(pairs, "member_id", "inner"), ["campaign_id"],
                           "attributed_mrr", "attributed_subscriptions")


def campaigns_with_revenue(campaigns: DataFrame, attributed: DataFrame) -> DataFrame:
    """J2 + P13: every campaign, with zero (not null) where nothing is attributed."""
    return campaigns.join(attributed, "campaign_id", "left").select(
        "campaign_id", "campaign_name", "channel", "target_audience", "spend", "conversions",
        default_zero("attributed_mrr").cast(MONEY_SUM).alias("attributed_mrr"),
        default_zero("attributed_subscriptions").cast("bigint").alias("attributed_subscriptions"),
    )


def campaign_ratios(df: DataFrame) -> DataFrame:
    """P14 + P15: cost per attributed subscription and payback months, null
    when the denominator is not positive."""
    return df.withColumns({
        "spend_per_attributed_subscription": guarded_ratio("spend", "attributed_subscriptions"),
        "payback_period_months": guarded_ratio("spend", "attributed_mrr"),
    })


def revenue_by_campaign(subscriptions: DataFrame, members: DataFrame, acquisition: DataFrame,
                        campaigns: DataFrame, sort: bool = True) -> DataFrame:
    """Campaigns with attributed active MRR, CAC and payback.

    Sorted by attributed MRR descending (nulls last), then campaign id as a
    tiebreaker (Q5).  The campaign side is small, so the final sort is cheap.
    """
    out = campaign_ratios(campaigns_with_revenue(
        campaigns, attributed_revenue(subscriptions, members, acquisition)))
    if sort:
        out = out.orderBy(F.col("attributed_mrr").desc_nulls_last(), F.col("campaign_id"))
    return out


def revenue_by_segment(subscriptions: DataFrame, members: DataFrame, accounts: DataFrame,
                       plans: DataFrame, status: str = "active") -> DataFrame:
    """K13 [inferred]: active MRR and active subscriptions by account type and plan name.

    Inner joins, since both group columns are declared not null.  As in K14,
    subscriptions are folded per (member, plan) before any join, and the
    member -> account type and plan -> plan name sides carry their join
    multiplicities; accounts and plans are look-ups.
    """
    active = subscriptions.filter(F.col("status") == status)
    member_type = lookup_join(members.select("member_id", "account_id"), accounts.select("account_id", "account_type"), "account_id") \
        .groupBy("member_id", "account_type").agg(F.count(F.lit(1)).alias("__km"))
    plan_name = plans.groupBy("plan_id", "plan_name").agg(F.count(F.lit(1)).alias("__kp"))
    held = holdings(active, ["member_id", "plan_id"]).join(member_type, "member_id", "inner")
    return grouped_revenue(lookup_join(held, plan_name, "plan_id").withColumn("__k", F.col("__km") * F.col("__kp")),
                           ["account_type", "plan_name"], "active_mrr", "active_subscriptions")


def month_spine(start: Column, end: Column, frame: DataFrame) -> DataFrame:
    """One row per calendar month between two dates (inclusive).

    ``frame`` is a one-row frame holding the columns ``start`` and ``end``
    refer to; its size is one row, so the spine is bounded by the month count.
    A start after the end gives no months.
    """
    first, last = F.trunc(start, "month"), F.trunc(end, "month")
    seq = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month"))) \
        .otherwise(F.array().cast("array<date>"))
    return frame.select(F.explode(seq).alias("month_start"))


def monthly_revenue(subscriptions: DataFrame, orders: DataFrame, as_of: dt.date | str,
                    order_statuses: list[str] | None = None) -> DataFrame:
    """K11 [inferred]: one row per month from the first subscription to the as-of month.

    A subscription counts in month m when its start month <= m and its end
    date is null or its end month >= m; so a null start, or an end month
    before the start month, never counts.  Computed in delta form: +amount at
    the start month, -amount in the month after the end month, summed per
    month (map-side combined to at most one row per month per task), then a
    running sum over the month spine.  The spine has one row per month, so
    its unpartitioned window is small by construction.  One-time revenue is
    the sum of order amounts per order month (all statuses unless given).
    """
    as_of_col = F.lit(as_of).cast("date")
    subs = subscriptions.select("start_date", "end_date", "billed_amount")
    start_m = F.trunc("start_date", "month")
    end_next = F.add_months(F.trunc("end_date", "month"), 1)
    # a row without a start, or with an end before its start month, never counts
    valid = F.col("start_date").isNotNull() & (F.col("end_date").isNull() | (F.trunc("end_date", "month") >= start_m))
    deltas = subs.filter(valid).select(F.explode(F.array(
        F.struct(start_m.alias("m"), F.col("billed_amount").alias("amt"), F.lit(1).alias("n")),
        F.when(F.col("end_date").isNotNull(),
               F.struct(end_next.alias("m"), (-F.col("billed_amount")).alias("amt"), F.lit(-1).alias("n"))),
    )).alias("d")).filter(F.col("d").isNotNull()).select("d.*")
    per_month = deltas.groupBy("m").agg(F.sum("amt").alias("d_amt"), F.sum("n").alias("d_n"))

    o = orders
    if order_statuses is not None:
        o = o.filter(F.col("status").isin(order_statuses))
    one_time = o.groupBy(F.trunc("order_date", "month").alias("m")).agg(
        F.sum("amount").alias("one_time"))

    first = subscriptions.agg(F.min("start_date").alias("first_start"))
    spine = month_spine(F.col("first_start"), as_of_col, first)

    w = Window.orderBy("month_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = spine.join(F.broadcast(per_month), spine.month_start == per_month.m, "left").drop("m") \
        .join(F.broadcast(one_time), spine.month_start == one_time.m, "left").drop("m")
    return joined.select(
        "month_start",
        F.sum(default_zero("d_amt")).over(w).cast(MONEY_SUM).alias("mrr"),
        F.sum(default_zero("d_n")).over(w).cast("bigint").alias("active_subscriptions"),
        default_zero("one_time").cast(MONEY_SUM).alias("one_time_revenue"),
    )


def revenue_trend(monthly: DataFrame) -> DataFrame:
    """K12 [inferred]: stored passthrough of the monthly revenue model."""
    return monthly.select("month_start", "mrr", "active_subscriptions", "one_time_revenue")
