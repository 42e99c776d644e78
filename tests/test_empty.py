"""Every main operator accepts empty input and returns an empty (or zero) result."""

import datetime as dt

from tallyframe.operators import calendar as cal
from tallyframe.operators import matching as mt
from tallyframe.operators import quality as dq
from tallyframe.operators import sampling as sm
from tallyframe.plans import engagement as eg
from tallyframe.plans import revenue as rv

SUBS = "subscription_id string, member_id string, plan_id string, start_date date, end_date date, status string, " \
       "billed_amount decimal(18,2)"
ORDERS = "order_id string, member_id string, order_type string, order_date date, amount decimal(18,2), status string"


def test_empty_numbering_and_sampling(spark):
    e = spark.createDataFrame([], "k bigint, v string")
    assert sm.dense_number(e, ["k"]).count() == 0
    assert sm.exact_n_sample(e, "0.5", ["k"]).count() == 0
    assert sm.zip_by_rank(e, ["k"], spark.range(3).withColumnRenamed("id", "k"), ["k"]).count() == 0
    assert sm.replicate_rows(spark.createDataFrame([], "k string, n int"), "n").count() == 0


def test_empty_revenue_and_engagement(spark):
    subs = spark.createDataFrame([], SUBS)
    orders = spark.createDataFrame([], ORDERS)
    assert rv.monthly_revenue(subs, orders, dt.date(2024, 6, 30)).count() == 0
    members = spark.createDataFrame([], "member_id string, account_id string, join_date date")
    accounts = spark.createDataFrame([], "account_id string, account_type string")
    plans = spark.createDataFrame([], "plan_id string, tier string")
    activity = spark.createDataFrame([], "member_id string, activity_date date, is_active_day boolean")
    assert eg.engagement_and_value(members, accounts, subs, plans, orders, activity).count() == 0


def test_empty_matching_spine_and_quality(spark):
    ents = spark.createDataFrame([], "account_id string, account_type string, acquisition_date date")
    camps = spark.createDataFrame([], "campaign_id string, target_audience string, start_date date, end_date date")
    assert mt.attribute_accounts(ents, camps).count() == 0
    assert cal.entity_day_spine(spark.createDataFrame([], "k string, j date"), "k", "j",
                                dt.date(2024, 1, 30)).count() == 0
    report = dq.Suite(unique=[("t", "k")], not_null=[("t", "k")], accepted_values=[("t", "k", ["a"])],
                      relationships=[("t", "k", "t", "k")]).run({"t": spark.createDataFrame([], "k string")})
    assert {(r.test_name, r.failures, r.passed) for r in report.collect()} == {
        ("unique", 0, True), ("not_null", 0, True), ("accepted_values", 0, True), ("relationships", 0, True)}
