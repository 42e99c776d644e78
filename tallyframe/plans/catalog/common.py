"""Typed test-data relations shared by the catalog modules."""

from __future__ import annotations

from ...sources import testdata as td
from .. import staging as st

M = td.MONEY


def accounts(spark, d):
    return st.stage_accounts(td.raw_accounts(spark, d), money=M)


def members(spark, d):
    return st.stage_members(td.raw_members(spark, d))


def plans(spark, d):
    return st.stage_plans(td.raw_plans(spark, d), money=M)


def subscriptions(spark, d):
    return st.stage_subscriptions(td.raw_subscriptions(spark, d), money=M)


def orders(spark, d):
    return st.stage_orders(td.raw_orders(spark, d), money=M)


def campaigns(spark, d):
    return st.stage_campaigns(td.raw_campaigns(spark, d), money=M)


def acquisition(spark, d):
    return st.stage_acquisition(td.raw_acquisition(spark, d))


def activity(spark, d):
    return td.activity_days(spark, d)


def tickets(spark, d):
    return st.stage_tickets(td.raw_tickets(spark, d))
