"""Data-quality queries on the test tables: one report row per declared test."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from ... import fixed_values as fv
from ...operators import quality as dq
from ...sources import testdata as td
from ..oracle_base import sql
from ..declared_tests import DECLARED_SUITE, run_declared_suite
from . import common as c
from .revenue import MONTHLY_SQL, RATIOS_SQL, SEGMENT_SQL
from .registry import register

SUITE = dq.Suite(
    unique=[("events", "user_id"), ("orders", "o_orderkey"), ("one_time_orders", "order_id"),
            ("members", "member_id"), ("acquisition", "account_id")],
    not_null=[("subscriptions", "end_date"), ("accounts", "per_member_rate"), ("tickets", "csat_rating"),
              ("tickets", "resolved_at"), ("members", "member_id"), ("members", "join_date")],
    accepted_values=[("orders", "o_orderstatus", ["O", "F"]),
                     ("tickets", "ticket_category", list(fv.TICKET_CATEGORIES)),
                     ("subscriptions", "status", ["active"]),
                     ("campaigns", "channel", list(fv.CHANNELS))],
    relationships=[("customer", "c_nationkey", "nation", "n_nationkey"),
                   # business rule: a sponsored member's account must carry a per-member rate
                   ("sponsored_members", "account_id", "rated_accounts", "account_id"),
                   ("subscriptions", "member_id", "members", "member_id"),
                   ("tickets", "member_id", "members", "member_id"),
                   ("acquisition", "campaign_id", "campaigns", "campaign_id")],
)

# tables the oracle reads as CTEs (the rest are the driver's views)
STAGED = ("one_time_orders", "members", "acquisition", "subscriptions", "accounts", "tickets", "campaigns")


def tables(spark, d):
    members, accounts = c.members(spark, d), c.accounts(spark, d)
    return {
        "events": td.table(spark, d, "events"),
        "orders": td.table(spark, d, "orders"),
        "customer": td.table(spark, d, "customer"),
        "nation": td.table(spark, d, "nation"),
        "one_time_orders": c.orders(spark, d),
        "members": members,
        "sponsored_members": members.filter(F.col("sponsored")),
        "rated_accounts": accounts.filter(F.col("per_member_rate").isNotNull()),
        "acquisition": c.acquisition(spark, d),
        "subscriptions": c.subscriptions(spark, d),
        "accounts": accounts,
        "tickets": c.tickets(spark, d),
        "campaigns": c.campaigns(spark, d),
    }


def _lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


DERIVED = {
    "sponsored_members": "(select * from members where sponsored)",
    "rated_accounts": "(select * from accounts where per_member_rate is not null)",
}


def _src(model: str) -> str:
    return DERIVED.get(model, model)


Src = Callable[[str], str]


def _head(model: str, col: str, test: str) -> str:
    return f"select {_lit(model)} as model, {_lit(col)} as column_name, {_lit(test)} as test_name"


def unique_sql(suite: dq.Suite, src: Src = _src) -> list[str]:
    return [f"""{_head(m, col, 'unique')}, count(*) as failures, count(*) = 0 as passed
from (select {col} from {src(m)} t0 where {col} is not null group by {col} having count(*) > 1) t"""
            for m, col in suite.unique]


def not_null_sql(suite: dq.Suite, src: Src = _src) -> list[str]:
    return [f"""{_head(m, col, 'not_null')}, count(*) filter (where {col} is null) as failures,
       count(*) filter (where {col} is null) = 0 as passed from {src(m)} t0""" for m, col in suite.not_null]


def accepted_sql(suite: dq.Suite, src: Src = _src) -> list[str]:
    out = []
    for m, col, values in suite.accepted_values:
        vals = ", ".join(_lit(v) for v in values)
        out.append(f"""{_head(m, col, 'accepted_values')}, count(distinct {col}) as failures,
       count(distinct {col}) = 0 as passed from {src(m)} t0 where {col} is not null and {col} not in ({vals})""")
    return out


def relationships_sql(suite: dq.Suite, src: Src = _src) -> list[str]:
    return [f"""{_head(m, col, 'relationships')}, count(*) as failures, count(*) = 0 as passed
from {src(m)} ch where ch.{col} is not null
  and not exists (select 1 from {src(p)} pa where pa.{pc} = ch.{col})""" for m, col, p, pc in suite.relationships]


def _union(parts: list[str], deps: tuple[str, ...] = STAGED) -> str:
    return sql("\nunion all\n".join(f"select * from ({p}) q{i}" for i, p in enumerate(parts)), *deps)


@register("dq_unique", _union(unique_sql(dq.Suite(unique=SUITE.unique))))
def dq_unique(spark, d):
    return dq.Suite(unique=SUITE.unique).run(tables(spark, d))


@register("dq_not_null", _union(not_null_sql(dq.Suite(not_null=SUITE.not_null))))
def dq_not_null(spark, d):
    return dq.Suite(not_null=SUITE.not_null).run(tables(spark, d))


@register("dq_accepted_values", _union(accepted_sql(dq.Suite(accepted_values=SUITE.accepted_values))))
def dq_accepted_values(spark, d):
    return dq.Suite(accepted_values=SUITE.accepted_values).run(tables(spark, d))


@register("dq_relationships", _union(relationships_sql(dq.Suite(relationships=SUITE.relationships))))
def dq_relationships(spark, d):
    return dq.Suite(relationships=SUITE.relationships).run(tables(spark, d))


@register("dq_report", _union(unique_sql(SUITE) + not_null_sql(SUITE) + accepted_sql(SUITE)
                              + relationships_sql(SUITE)))
def dq_report(spark, d):
    return SUITE.run(tables(spark, d))


# --------------------------------------------------------------------------- the reference's own tests

DECLARED_SRC = {
    "stg_accounts": "accounts", "stg_members": "members", "stg_plans": "plans",
    "stg_subscriptions": "subscriptions", "stg_workouts": "workouts", "stg_orders": "one_time_orders",
    "stg_support_tickets": "tickets", "stg_campaigns": "campaigns", "stg_account_acquisition": "acquisition",
    "int_member_streaks": "workout_streaks",
    "int_monthly_revenue": f"({MONTHLY_SQL})", "mart_revenue_trend": f"({MONTHLY_SQL})",
    "mart_revenue_by_segment": f"({SEGMENT_SQL})", "mart_revenue_by_campaign": f"({RATIOS_SQL})",
}
DECLARED_DEPS = ("accounts", "members", "plans", "subscriptions", "workouts", "one_time_orders", "tickets",
                 "campaigns", "acquisition", "workout_streaks")


def raw_tables(spark, d):
    return {
        "accounts": td.raw_accounts(spark, d), "members": td.raw_members(spark, d),
        "plans": td.raw_plans(spark, d), "subscriptions": td.raw_subscriptions(spark, d),
        "workouts": td.raw_workouts(spark, d), "orders": td.raw_orders(spark, d),
        "support_tickets": td.raw_tickets(spark, d), "campaigns": td.raw_campaigns(spark, d),
        "account_acquisition": td.raw_acquisition(spark, d),
    }


@register("dq_declared_suite", _union(
    unique_sql(DECLARED_SUITE, DECLARED_SRC.get) + not_null_sql(DECLARED_SUITE, DECLARED_SRC.get)
    + accepted_sql(DECLARED_SUITE, DECLARED_SRC.get) + relationships_sql(DECLARED_SUITE, DECLARED_SRC.get),
    DECLARED_DEPS))
def dq_declared_suite(spark, d):
    """The reference's 57 declared column tests over the staged test data and derived models."""
    return run_declared_suite(raw_tables(spark, d), td.ORDERS_AS_OF, money=td.MONEY)
