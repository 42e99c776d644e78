import datetime as dt

from pyspark.sql import functions as F

from helpers import d, dec, rows
from tallyframe.plans import revenue as rv

SUBS = "subscription_id string, member_id string, plan_id string, start_date date, end_date date, status string, " \
       "billed_amount decimal(18,2)"


def fixture(spark):
    members = spark.createDataFrame([("m1", "a1"), ("m2", "a1"), ("m3", "a2"), ("m4", "a3"), ("m5", "a4")],
                                    "member_id string, account_id string")
    acquisition = spark.createDataFrame([("a1", "c1"), ("a2", "c2"), ("a4", "c4")],
                                        "account_id string, campaign_id string")
    campaigns = spark.createDataFrame([
        ("c1", "One", "email", "individual", dec("100.00"), 3),
        ("c2", "Two", "email", "individual", dec("100.00"), 1),
        ("c3", "Three", "email", "organization", dec("50.00"), 0),
        ("c4", "Four", "email", "organization", dec("10.00"), 0)],
        "campaign_id string, campaign_name string, channel string, target_audience string, "
        "spend decimal(18,2), conversions int")
    subs = spark.createDataFrame([
        ("s1", "m1", "p", d("2024-01-01"), None, "active", dec("30.00")),
        ("s2", "m1", "p", d("2024-01-01"), None, "active", dec("30.00")),   # member with two subscriptions
        ("s3", "m2", "p", d("2024-01-01"), None, "active", dec("40.00")),
        ("s4", "m3", "p", d("2024-01-01"), None, "active", dec("30.00")),
        ("s5", "m3", "p", d("2024-01-01"), d("2024-02-01"), "ended", dec("99.00")),  # not active
        ("s6", "m4", "p", d("2024-01-01"), None, "active", dec("10.00")),   # account without campaign
        ("s7", "m5", "p", d("2024-01-01"), None, "active", dec("0.00")),    # revenue of exactly 0
    ], SUBS)
    return subs, members, acquisition, campaigns


def test_revenue_by_campaign(spark):
    out = rv.revenue_by_campaign(*fixture(spark))
    got = [(r.campaign_id, r.attributed_mrr, r.attributed_subscriptions, r.spend_per_attributed_subscription,
            r.payback_period_months) for r in out.collect()]
    assert got == [
        ("c1", dec("100.00"), 3, dec("33.33"), dec("1.00")),
        ("c2", dec("30.00"), 1, dec("100.00"), dec("3.33")),
        ("c3", dec("0.00"), 0, None, None),     # campaign without revenue: zero, null ratios
        ("c4", dec("0.00"), 1, dec("10.00"), None),  # revenue exactly 0: payback undefined
    ]


def test_half_way_rounding_is_half_up(spark):
    df = spark.createDataFrame([(dec("0.25"), 2), (dec("1.00"), 8), (dec("-5.00"), -1)], "n decimal(18,2), c bigint")
    from tallyframe.functions.exprs import guarded_ratio
    got = [r.x for r in df.select(guarded_ratio("n", "c").alias("x")).collect()]
    assert got == [dec("0.13"), dec("0.13"), None]


def test_revenue_by_segment_totals_match_active_subscriptions(spark):
    subs, members, _, _ = fixture(spark)
    accounts = spark.createDataFrame([("a1", "individual"), ("a2", "individual"), ("a3", "organization"),
                                      ("a4", "organization")], "account_id string, account_type string")
    plans = spark.createDataFrame([("p", "Standard")], "plan_id string, plan_name string")
    seg = rv.revenue_by_segment(subs, members, accounts, plans)
    assert rows(seg) == [("individual", "Standard", dec("130.00"), 4), ("organization", "Standard", dec("10.00"), 2)]
    total = subs.filter("status = 'active'").agg(F.sum("billed_amount")).collect()[0][0]
    assert seg.agg(F.sum("active_mrr")).collect()[0][0] == total


def months_fixture(spark):
    return spark.createDataFrame([
        ("s1", "m", "p", d("2024-01-15"), None, "active", dec("10.00")),            # open end
        ("s2", "m", "p", d("2024-02-03"), d("2024-02-20"), "ended", dec("5.00")),   # start and end in one month
        ("s3", "m", "p", d("2024-01-31"), d("2024-03-01"), "ended", dec("7.00")),   # ends on a first day
        ("s4", "m", "p", d("2024-02-01"), d("2024-04-30"), "ended", dec("3.00")),   # ends on a last day
        ("s5", "m", "p", d("2024-09-01"), None, "active", dec("100.00")),           # starts after the as-of date
    ], SUBS)


def brute_force(subs, as_of):
    first = min(r.start_date for r in subs).replace(day=1)
    out, m = {}, first
    while m <= as_of.replace(day=1):
        total = sum((r.billed_amount for r in subs if r.start_date.replace(day=1) <= m
                     and (r.end_date is None or r.end_date.replace(day=1) >= m)), dec("0.00"))
        out[m] = total
        m = (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return out


def test_monthly_delta_form_equals_interval_form(spark):
    subs = months_fixture(spark)
    orders = spark.createDataFrame([("o1", "m", "t", d("2024-03-10"), dec("2.50"), "completed")],
                                   "order_id string, member_id string, order_type string, order_date date, "
                                   "amount decimal(18,2), status string")
    as_of = d("2024-06-30")
    got = {r.month_start: (r.mrr, r.one_time_revenue) for r in rv.monthly_revenue(subs, orders, as_of).collect()}
    want = brute_force(subs.collect(), as_of)
    assert sorted(got) == sorted(want)
    assert {m: v[0] for m, v in got.items()} == want
    assert got[d("2024-03-01")][1] == dec("2.50") and got[d("2024-05-01")] == (dec("10.00"), dec("0.00"))
    assert got[d("2024-06-01")][0] == dec("10.00")  # month with no event still appears


def test_month_spine_bounds(spark):
    one = spark.createDataFrame([(d("2023-11-30"),)], "s date")
    spine = rv.month_spine(F.col("s"), F.lit(d("2024-02-01")), one)
    assert [r.month_start for r in spine.collect()] == [d("2023-11-01"), d("2023-12-01"), d("2024-01-01"),
                                                         d("2024-02-01")]


def test_monthly_all_after_as_of_is_empty(spark):
    subs = spark.createDataFrame([("s1", "m", "p", d("2024-09-01"), None, "active", dec("5.00"))], SUBS)
    orders = spark.createDataFrame([], "order_id string, member_id string, order_type string, order_date date, "
                                       "amount decimal(18,2), status string")
    assert rv.monthly_revenue(subs, orders, d("2024-06-30")).count() == 0


def test_attributed_plus_unattributed_is_total(spark):
    subs, members, acquisition, campaigns = fixture(spark)
    attributed = rv.attributed_revenue(subs, members, acquisition).agg(F.sum("attributed_mrr")).collect()[0][0]
    active = subs.filter("status = 'active'")
    unattributed = active.join(members, "member_id").join(acquisition, "account_id", "left_anti") \
        .agg(F.sum("billed_amount")).collect()[0][0]
    total = active.agg(F.sum("billed_amount")).collect()[0][0]
    assert attributed + unattributed == total == dec("140.00")


def test_fanout_multiplies_the_sum_not_the_distinct_count(spark):
    subs, members, acquisition, campaigns = fixture(spark)
    doubled = acquisition.unionByName(spark.createDataFrame([("a2", "c2")], "account_id string, campaign_id string"))
    got = {r.campaign_id: (r.attributed_mrr, r.attributed_subscriptions)
           for r in rv.attributed_revenue(subs, members, doubled).collect()}
    assert got["c2"] == (dec("60.00"), 1)     # one subscription of 30.00, joined twice
    assert got["c1"] == (dec("100.00"), 3)
