"""Table-shaped jobs of the reference's data preparation, as Spark operators:
billing resolution (K18), ticket resolution bands (K19), campaign labels,
unit conversion and coverage summaries (A13).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (DEFAULT_RESOLUTION_DAYS, LABEL_SEPARATOR, RESOLUTION_DAYS_BY_PRIORITY,
                            RESOLVED_STATUS_KEYWORDS)
from ..functions.exprs import any_keyword, clamp, first_keyword_band, lifecycle_status, miles_to_km, \
    title_label, truncating_int
from ..operators.joins import HOT_KEY_ROWS, lookup_join


def billing_resolution(subscriptions: DataFrame, members: DataFrame, accounts: DataFrame,
                       plans: DataFrame, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """K18 (J8): sponsored members pay their account's per-member rate, everyone
    else the plan's list price.

    Members are joined to their account first, so subscriptions meet one
    member-level and one plan-level look-up.  Each is a
    :func:`~tallyframe.operators.joins.lookup_join`: broadcast if it measures
    small enough, otherwise shuffled with the heavy members, accounts or
    plans of a sketch dealt over several tasks.
    """
    rates = lookup_join(members.select("member_id", "account_id", "sponsored"),
                        accounts.select("account_id", "per_member_rate"), "account_id", "left", hot_rows)
    joined = lookup_join(subscriptions.select("subscription_id", "member_id", "plan_id"),
                         plans.select("plan_id", "monthly_price"), "plan_id", "inner", hot_rows)
    joined = lookup_join(joined, rates, "member_id", "inner", hot_rows)
    return joined.select(
        "subscription_id", "member_id", "plan_id", "sponsored",
        F.when(F.col("sponsored"), F.col("per_member_rate")).otherwise(F.col("monthly_price"))
        .cast("decimal(18,2)").alias("billed_amount"))


def resolution_bands(tickets: DataFrame, as_of: dt.date | str, offset: Column | str, *, key: str = "ticket_id",
                     priority: str = "ticket_priority", status: str = "ticket_status",
                     created: str = "created_at", bands=RESOLUTION_DAYS_BY_PRIORITY,
                     default=DEFAULT_RESOLUTION_DAYS, keywords=RESOLVED_STATUS_KEYWORDS) -> DataFrame:
    """K19 (P23 P24 P18 P21): resolution date for resolved tickets.

    The first priority keyword found picks a (min, max) day window; ``offset``
    (whole, not negative) is taken round that window to a day count, and the
    date is capped at the as-of date.  Unresolved tickets, and tickets
    without an offset or creation date, get a null date.
    """
    band = first_keyword_band(priority, bands, default)
    t = tickets.withColumn("__band", band)
    low, high = F.col("__band.low"), F.col("__band.high")
    given = F.col(offset) if isinstance(offset, str) else offset
    days = low + F.pmod(given, high - low + 1).cast("int")
    resolved = any_keyword(status, keywords)
    date = F.date_add(F.col(created), days)
    date = F.when(date.isNotNull(), clamp(date, high=F.lit(as_of).cast("date")))
    return t.select(
        key, priority, status, created,
        low.alias("band_low"), high.alias("band_high"),
        F.when(resolved, date).alias("resolved_at"))


def campaign_labels(campaigns: DataFrame, as_of: dt.date | str, theme: Column | str = "theme") -> DataFrame:
    """P25 + P26: ``theme - Channel Name`` labels and a lifecycle status; the theme is the campaign's own."""
    return campaigns.select(
        "campaign_id",
        title_label(theme, "channel", LABEL_SEPARATOR).alias("campaign_label"),
        lifecycle_status("end_date", F.lit(as_of).cast("date")).alias("status"))


def unit_conversion(df: DataFrame, key: str, miles: str) -> DataFrame:
    """Miles to kilometres (2 places) and a truncating integer parse."""
    return df.select(key, miles_to_km(miles).alias("distance_km"),
                     truncating_int(F.col(miles).cast("string")).alias("whole_value"))


def coverage_summary(population: DataFrame, key: str, others: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row with the population size and, per related table, how many
    of the population appear in it and their percentage (1 place).

    Each related table is reduced to its distinct keys (map-side) before it
    meets the population.
    """
    base = population.select(F.col(key).alias("__k")).distinct()
    aggs = [F.count(F.lit(1)).alias("population")]
    for name, (df, col) in others.items():
        keys = df.select(F.col(col).alias("__k")).distinct().withColumn(f"__has_{name}", F.lit(True))
        base = base.join(keys, "__k", "left")
        aggs.append(F.count_if(F.col(f"__has_{name}").isNotNull()).alias(f"with_{name}"))
    g = base.agg(*aggs)
    pcts = [F.round(F.col(f"with_{n}").cast("decimal(20,0)") * 100 / F.col("population").cast("decimal(20,0)"), 1)
            .cast("decimal(18,1)").alias(f"pct_with_{n}") for n in others]
    return g.select("*", *pcts)
