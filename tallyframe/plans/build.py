"""The model build: raw tables -> staging views -> intermediate views -> stored marts.

This is the Spark form of the reference's model run (SURVEY §3.1): each model
is a function, the dependency graph is plain function composition, staging
and intermediate relations are registered as temporary views (S9), and marts
are written as tables with a full refresh (S5/S10) whose row counts form the
load report (S6).  The ad-hoc KPI query (K15) runs over the same relations.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators import streaks as sk
from ..sources.sinks import as_view, load_all
from . import engagement as eg
from . import revenue as rv
from . import staging as st


def stage_all(raw: Mapping[str, DataFrame], money: str | None = None) -> dict[str, DataFrame]:
    """K1-K9 over the raw tables that are present (keys as in ``sources.text.RAW_FILES``)."""
    makers = {
        "accounts": ("stg_accounts", lambda df: st.stage_accounts(df, money)),
        "members": ("stg_members", st.stage_members),
        "plans": ("stg_plans", lambda df: st.stage_plans(df, money)),
        "subscriptions": ("stg_subscriptions", lambda df: st.stage_subscriptions(df, money)),
        "workouts": ("stg_workouts", lambda df: st.stage_workouts(df, money)),
        "orders": ("stg_orders", lambda df: st.stage_orders(df, money)),
        "support_tickets": ("stg_support_tickets", st.stage_tickets),
        "campaigns": ("stg_campaigns", lambda df: st.stage_campaigns(df, money)),
        "account_acquisition": ("stg_account_acquisition", st.stage_acquisition),
    }
    return {name: make(raw[src]) for src, (name, make) in makers.items() if src in raw}


def build_models(spark: SparkSession, raw: Mapping[str, DataFrame], namespace: str,
                 as_of: dt.date | str, money: str | None = None,
                 base_path: str | None = None) -> DataFrame:
    """Register staging and intermediate views and store the marts.

    Returns the load report (table_name, rows) of the stored marts.  Marts
    whose inputs are missing are skipped, like a model whose source is absent.
    """
    staged = {name: as_view(df, name) for name, df in stage_all(raw, money).items()}
    marts: dict[str, DataFrame] = {}
    if "stg_workouts" in staged:
        as_view(sk.member_streaks(staged["stg_workouts"]), "int_member_streaks")
    if {"stg_subscriptions", "stg_orders"} <= staged.keys():
        monthly = as_view(rv.monthly_revenue(staged["stg_subscriptions"], staged["stg_orders"], as_of),
                          "int_monthly_revenue")
        marts["mart_revenue_trend"] = rv.revenue_trend(monthly)
    if {"stg_subscriptions", "stg_members", "stg_accounts", "stg_plans"} <= staged.keys():
        marts["mart_revenue_by_segment"] = rv.revenue_by_segment(
            staged["stg_subscriptions"], staged["stg_members"], staged["stg_accounts"], staged["stg_plans"])
    if {"stg_subscriptions", "stg_members", "stg_account_acquisition", "stg_campaigns"} <= staged.keys():
        marts["mart_revenue_by_campaign"] = rv.revenue_by_campaign(
            staged["stg_subscriptions"], staged["stg_members"], staged["stg_account_acquisition"],
            staged["stg_campaigns"], sort=False)
    return load_all(spark, marts, namespace, base_path)


def engagement_report(spark: SparkSession) -> DataFrame:
    """K15 over the registered staging and intermediate views."""
    return eg.engagement_and_value(
        spark.table("stg_members"), spark.table("stg_accounts"), spark.table("stg_subscriptions"),
        spark.table("stg_plans"), spark.table("stg_orders"), spark.table("stg_workouts"),
        streaks=spark.table("int_member_streaks"))
