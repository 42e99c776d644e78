"""Staging queries K1-K9 on the test tables."""

from __future__ import annotations

from ...sources import testdata as td
from .. import staging as st
from ..oracle_base import sql
from .registry import register

M = td.MONEY


@register("stage_accounts", sql("select * from accounts", "accounts"))
def stage_accounts(spark, d):
    return st.stage_accounts(td.raw_accounts(spark, d), money=M)


@register("stage_members", sql("select * from members", "members"))
def stage_members(spark, d):
    return st.stage_members(td.raw_members(spark, d))


@register("stage_plans", sql("select * from plans", "plans"))
def stage_plans(spark, d):
    return st.stage_plans(td.raw_plans(spark, d), money=M)


@register("stage_subscriptions", sql("select * from subscriptions", "subscriptions"))
def stage_subscriptions(spark, d):
    return st.stage_subscriptions(td.raw_subscriptions(spark, d), money=M)


@register("stage_orders", sql("select * from one_time_orders", "one_time_orders"))
def stage_orders(spark, d):
    return st.stage_orders(td.raw_orders(spark, d), money=M)


@register("stage_acquisition", sql("select * from acquisition", "acquisition"))
def stage_acquisition(spark, d):
    return st.stage_acquisition(td.raw_acquisition(spark, d))


@register("stage_campaigns", sql("select * from campaigns", "campaigns"))
def stage_campaigns(spark, d):
    return st.stage_campaigns(td.raw_campaigns(spark, d), money=M)


@register("stage_activity", sql("select * from workouts", "workouts"))
def stage_activity(spark, d):
    return st.stage_workouts(td.raw_workouts(spark, d), money=M)


@register("stage_tickets", sql("select * from tickets", "tickets"))
def stage_tickets(spark, d):
    return st.stage_tickets(td.raw_tickets(spark, d))
