"""The model build over raw text tables derived from the smallest test scale."""

from helpers import rows
from tallyframe.plans import build, revenue as rv
from tallyframe.plans.catalog import common as c
from tallyframe.sources import testdata as td

SF = "/root/testdata/sf0.001"


def raw_tables(spark):
    return {
        "accounts": td.raw_accounts(spark, SF), "members": td.raw_members(spark, SF),
        "plans": td.raw_plans(spark, SF), "subscriptions": td.raw_subscriptions(spark, SF),
        "workouts": td.raw_workouts(spark, SF), "orders": td.raw_orders(spark, SF),
        "support_tickets": td.raw_tickets(spark, SF), "campaigns": td.raw_campaigns(spark, SF),
        "account_acquisition": td.raw_acquisition(spark, SF),
    }


def test_build_models_stores_marts_and_views(spark):
    report = {r.table_name: r.rows for r in
              build.build_models(spark, raw_tables(spark), "marts_test", td.ORDERS_AS_OF, money=td.MONEY).collect()}
    assert set(report) == {"mart_revenue_trend", "mart_revenue_by_segment", "mart_revenue_by_campaign"}
    assert report["mart_revenue_by_campaign"] == td.table(spark, SF, "supplier").count()
    stored = spark.table("marts_test.mart_revenue_by_campaign")
    direct = rv.revenue_by_campaign(c.subscriptions(spark, SF), c.members(spark, SF), c.acquisition(spark, SF),
                                    c.campaigns(spark, SF), sort=False)
    assert rows(stored) == rows(direct)
    assert spark.table("int_member_streaks").count() > 0
    kpi = build.engagement_report(spark)
    assert kpi.count() > 0 and "avg_longest_streak_days" in kpi.columns


def test_missing_source_skips_dependent_marts(spark):
    raw = raw_tables(spark)
    del raw["account_acquisition"]
    report = {r.table_name for r in build.build_models(spark, raw, "marts_partial", td.ORDERS_AS_OF,
                                                       money=td.MONEY).collect()}
    assert report == {"mart_revenue_trend", "mart_revenue_by_segment"}
