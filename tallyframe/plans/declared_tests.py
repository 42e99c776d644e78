"""The reference's declared column tests, as one data-quality suite.

57 tests over the staging models, the two intermediate models and the three
marts: 12 unique, 23 not null, 12 accepted values, 10 relationships.  Model
names are ours; :func:`models` builds every tested relation from the raw
text tables with the library's own functions.

Q-X: the ticket status column is deliberately left untested, as in the
reference - its values come from the source system and are not a closed list.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..fixed_values import (ACCOUNT_STATUSES, ACCOUNT_TYPES, AUDIENCES, CAMPAIGN_STATUSES, CHANNELS, DATA_SOURCES,
                            ELIGIBILITY_STATUSES, ORDER_STATUSES, ORDER_TYPES, PLAN_TIERS, SUBSCRIPTION_STATUSES,
                            TICKET_CATEGORIES)
from ..operators import streaks as sk
from ..session import ensure_checkpoint_dir
from ..operators.quality import Suite
from . import revenue as rv
from .build import stage_all

# fixed values: the declared tests, in their natural order
DECLARED_SUITE = Suite(
    unique=[
        ("stg_accounts", "account_id"), ("stg_members", "member_id"), ("stg_plans", "plan_id"),
        ("stg_subscriptions", "subscription_id"), ("stg_workouts", "workout_id"), ("stg_orders", "order_id"),
        ("stg_support_tickets", "ticket_id"), ("stg_campaigns", "campaign_id"),
        ("stg_account_acquisition", "account_id"), ("int_monthly_revenue", "month_start"),
        ("mart_revenue_trend", "month_start"), ("mart_revenue_by_campaign", "campaign_id"),
    ],
    not_null=[
        ("stg_accounts", "account_id"),
        ("stg_members", "member_id"), ("stg_members", "account_id"),
        ("stg_plans", "plan_id"),
        ("stg_subscriptions", "subscription_id"), ("stg_subscriptions", "member_id"),
        ("stg_subscriptions", "plan_id"), ("stg_subscriptions", "billed_amount"),
        ("stg_workouts", "workout_id"), ("stg_workouts", "member_id"),
        ("stg_orders", "order_id"), ("stg_orders", "member_id"),
        ("stg_support_tickets", "ticket_id"), ("stg_support_tickets", "member_id"),
        ("stg_campaigns", "campaign_id"),
        ("stg_account_acquisition", "account_id"), ("stg_account_acquisition", "campaign_id"),
        ("int_member_streaks", "member_id"),
        ("int_monthly_revenue", "month_start"),
        ("mart_revenue_trend", "month_start"),
        ("mart_revenue_by_segment", "account_type"), ("mart_revenue_by_segment", "plan_name"),
        ("mart_revenue_by_campaign", "campaign_id"),
    ],
    accepted_values=[
        ("stg_accounts", "account_type", ACCOUNT_TYPES), ("stg_accounts", "status", ACCOUNT_STATUSES),
        ("stg_members", "eligibility_status", ELIGIBILITY_STATUSES), ("stg_plans", "tier", PLAN_TIERS),
        ("stg_subscriptions", "status", SUBSCRIPTION_STATUSES), ("stg_workouts", "data_source", DATA_SOURCES),
        ("stg_orders", "order_type", ORDER_TYPES), ("stg_orders", "status", ORDER_STATUSES),
        ("stg_support_tickets", "ticket_category", TICKET_CATEGORIES), ("stg_campaigns", "channel", CHANNELS),
        ("stg_campaigns", "target_audience", AUDIENCES), ("stg_campaigns", "status", CAMPAIGN_STATUSES),
    ],
    relationships=[
        ("stg_members", "account_id", "stg_accounts", "account_id"),
        ("stg_subscriptions", "member_id", "stg_members", "member_id"),
        ("stg_subscriptions", "plan_id", "stg_plans", "plan_id"),
        ("stg_workouts", "member_id", "stg_members", "member_id"),
        ("stg_orders", "member_id", "stg_members", "member_id"),
        ("stg_support_tickets", "member_id", "stg_members", "member_id"),
        ("stg_account_acquisition", "account_id", "stg_accounts", "account_id"),
        ("stg_account_acquisition", "campaign_id", "stg_campaigns", "campaign_id"),
        ("int_member_streaks", "member_id", "stg_members", "member_id"),
        ("mart_revenue_by_campaign", "campaign_id", "stg_campaigns", "campaign_id"),
    ],
)


def models(raw: Mapping[str, DataFrame], as_of: dt.date | str, money: str | None = None,
           keep: bool = False) -> dict[str, DataFrame]:
    """Every relation the declared suite tests, built from the raw text tables.

    With ``keep`` the derived models are checkpointed to the shared folder, so
    that several tests of one model do not build it again.
    """
    m = stage_all(raw, money)
    staged = set(m)
    m["int_member_streaks"] = sk.member_streaks(m["stg_workouts"])
    m["int_monthly_revenue"] = rv.monthly_revenue(m["stg_subscriptions"], m["stg_orders"], as_of)
    m["mart_revenue_trend"] = rv.revenue_trend(m["int_monthly_revenue"])
    m["mart_revenue_by_segment"] = rv.revenue_by_segment(m["stg_subscriptions"], m["stg_members"],
                                                         m["stg_accounts"], m["stg_plans"])
    m["mart_revenue_by_campaign"] = rv.revenue_by_campaign(m["stg_subscriptions"], m["stg_members"],
                                                           m["stg_account_acquisition"], m["stg_campaigns"],
                                                           sort=False)
    if keep:
        ensure_checkpoint_dir(m["stg_members"].sparkSession)
        m |= {name: df.checkpoint() for name, df in m.items() if name not in staged and name != "mart_revenue_trend"}
        m["mart_revenue_trend"] = rv.revenue_trend(m["int_monthly_revenue"])
    return m


def run_declared_suite(raw: Mapping[str, DataFrame], as_of: dt.date | str, money: str | None = None) -> DataFrame:
    """The reference's 57 column tests over models built from ``raw``.

    The four derived models are written to the checkpoint folder when this is
    called, so the report is about that moment's data.
    """
    return DECLARED_SUITE.run(models(raw, as_of, money, keep=True))
