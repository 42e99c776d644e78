"""Staging models K1-K9: raw text tables to typed relations.

Each model is one ``select`` of casts over a raw text DataFrame (see
:mod:`tallyframe.functions.casting`).  Types default to the reference's
declared types; callers with wider money values pass ``money=...``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casting import ColumnCast as C
from ..functions.casting import apply_casts
from ..fixed_values import ACTIVE_MINUTES_THRESHOLD, TICKET_CATEGORY_MAP
from ..functions.exprs import case_insensitive_map, threshold_flag

ACCOUNTS = [
    C("account_id"), C("account_type"), C("account_name"), C("industry"), C("status"),
    C("per_member_rate", dtype="decimal(6,2)", blank_is_null=True),
]
MEMBERS = [
    C("member_id"), C("account_id"), C("email"),
    C("join_date", dtype="date"), C("eligibility_status"),
    C("sponsored", dtype="boolean"), C("is_fitbit_seed", dtype="boolean"),
]
PLANS = [C("plan_id"), C("plan_name"), C("tier"), C("monthly_price", dtype="decimal(6,2)")]
SUBSCRIPTIONS = [
    C("subscription_id"), C("member_id"), C("plan_id"),
    C("start_date", dtype="date"), C("end_date", dtype="date", blank_is_null=True),
    C("status"), C("billed_amount", dtype="decimal(6,2)"),
]
WORKOUTS = [
    C("workout_id"), C("member_id"), C("activity_date", dtype="date"),
    C("steps", dtype="int"), C("distance_km", dtype="decimal(6,2)"),
    C("very_active_minutes", dtype="int"), C("moderately_active_minutes", dtype="int"),
    C("light_active_minutes", dtype="int"), C("sedentary_minutes", dtype="int"),
    C("calories_burned", dtype="int"), C("data_source", source="source"),
]
ORDERS = [
    C("order_id"), C("member_id"), C("order_type"), C("order_date", dtype="date"),
    C("amount", dtype="decimal(6,2)"), C("status"),
]
TICKETS_TAIL = [
    C("ticket_status"), C("ticket_priority"), C("ticket_channel"),
    C("csat_rating", dtype="int", blank_is_null=True, integral_text=True, trim=True),
    C("created_at", dtype="date"), C("resolved_at", dtype="date", blank_is_null=True),
]
CAMPAIGNS = [
    C("campaign_id"), C("campaign_name"), C("channel"), C("target_audience"),
    C("start_date", dtype="date"), C("end_date", dtype="date"), C("status"),
    C("budget", dtype="decimal(10,2)"), C("spend", dtype="decimal(10,2)"),
    C("impressions", dtype="int"), C("clicks", dtype="int"), C("conversions", dtype="int"),
]



def _money(spec: list[C], money: str | None, names: tuple[str, ...]) -> list[C]:
    if money is None:
        return spec
    return [C(s.name, s.source, money, s.blank_is_null, s.integral_text, s.trim) if s.name in names else s
            for s in spec]


def stage_accounts(raw: DataFrame, money: str | None = None) -> DataFrame:
    """K1."""
    return apply_casts(raw, _money(ACCOUNTS, money, ("per_member_rate",)))


def stage_members(raw: DataFrame) -> DataFrame:
    """K2: ``True`` / ``False`` text becomes boolean."""
    return apply_casts(raw, MEMBERS)


def stage_plans(raw: DataFrame, money: str | None = None) -> DataFrame:
    """K3."""
    return apply_casts(raw, _money(PLANS, money, ("monthly_price",)))


def stage_subscriptions(raw: DataFrame, money: str | None = None) -> DataFrame:
    """K4: blank end date means open."""
    return apply_casts(raw, _money(SUBSCRIPTIONS, money, ("billed_amount",)))


def stage_workouts(raw: DataFrame, money: str | None = None,
                   threshold: int = ACTIVE_MINUTES_THRESHOLD) -> DataFrame:
    """K5: typed daily activity plus ``is_active_day`` (P10, null minutes count as not active)."""
    typed = apply_casts(raw, _money(WORKOUTS, money, ("distance_km",)))
    return typed.withColumn(
        "is_active_day",
        threshold_flag(["very_active_minutes", "moderately_active_minutes"], threshold))


def stage_orders(raw: DataFrame, money: str | None = None) -> DataFrame:
    """K6."""
    return apply_casts(raw, _money(ORDERS, money, ("amount",)))


def stage_tickets(raw: DataFrame) -> DataFrame:
    """K7: ticket type remapped case-insensitively (unmatched kept); rating via P9."""
    head = raw.select(
        "*", case_insensitive_map(F.col("ticket_type"), TICKET_CATEGORY_MAP).alias("ticket_category"))
    return apply_casts(head, [C("ticket_id"), C("member_id"), C("ticket_category")] + TICKETS_TAIL)


def stage_campaigns(raw: DataFrame, money: str | None = None) -> DataFrame:
    """K8."""
    return apply_casts(raw, _money(CAMPAIGNS, money, ("budget", "spend")))


def stage_acquisition(raw: DataFrame) -> DataFrame:
    """K9: passthrough."""
    return raw.select("*")
