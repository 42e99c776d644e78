from decimal import ROUND_HALF_UP, Decimal

from helpers import d, dec
from tallyframe.plans import engagement as eg


def fixture(spark):
    members = spark.createDataFrame([
        ("m1", "a1", d("2024-01-01")), ("m2", "a1", d("2024-01-11")), ("m3", "a2", d("2023-12-01")),
        ("m4", "zz", d("2024-01-20")),   # account missing: null account type group
        ("m5", "a2", d("2024-01-05")),   # no subscription: dropped by the inner join
    ], "member_id string, account_id string, join_date date")
    accounts = spark.createDataFrame([("a1", "organization"), ("a2", "individual")],
                                     "account_id string, account_type string")
    plans = spark.createDataFrame([("p1", "standard"), ("p2", "premium")], "plan_id string, tier string")
    subs = spark.createDataFrame([
        ("s1", "m1", "p1", dec("10.00")), ("s2", "m1", "p1", dec("10.00")),   # two subscriptions: fan-out
        ("s3", "m2", "p1", dec("15.00")), ("s4", "m3", "p2", dec("25.00")), ("s5", "m4", "p1", dec("5.00")),
    ], "subscription_id string, member_id string, plan_id string, billed_amount decimal(18,2)")
    orders = spark.createDataFrame([("o1", "m1", dec("3.00")), ("o2", "m1", dec("4.00")), ("o3", "m3", dec("1.00"))],
                                   "order_id string, member_id string, amount decimal(18,2)")
    activity = spark.createDataFrame([
        ("m1", d("2024-01-29"), True), ("m1", d("2024-01-30"), True), ("m1", d("2024-01-31"), True),
        ("m2", d("2024-01-20"), True), ("m2", d("2024-01-31"), True),
        ("m3", d("2024-01-01"), True), ("m3", d("2024-01-02"), True), ("m3", d("2024-01-10"), True),
    ], "member_id string, activity_date date, is_active_day boolean")
    return members, accounts, subs, plans, orders, activity


def r1(x):
    return Decimal(x).quantize(Decimal("0.1"), ROUND_HALF_UP)


def test_engagement_matches_fanout_arithmetic(spark):
    out = {(r.account_type, r.tier): r for r in eg.engagement_and_value(*fixture(spark)).collect()}
    org = out[("organization", "standard")]
    # fan-out rows: m1 twice (s1, s2) and m2 once
    assert org.count_members == 2
    assert org.total_billed_amount == dec("35.00")
    assert org.rev_per_member == dec("17.50")
    assert org.count_mem_with_current_streak == 3           # m1 counted per subscription row (Q3)
    assert org.avg_current_streak_length == r1(Decimal(3 + 3 + 1) / 3)
    assert org.avg_longest_streak_days == r1(Decimal(3 + 3 + 1) / 3)
    assert org.count_orders == 4                             # m1's 2 orders on each of its 2 rows
    days = [30, 30, 20]
    assert org.avg_length_of_membership_days == r1(Decimal(sum(days)) / 3)
    assert org.avg_length_of_membership_months == r1(Decimal(sum(days)) / 3 / 30)
    ind = out[("individual", "premium")]
    assert ind.count_mem_with_current_streak == 0 and ind.avg_current_streak_length is None
    assert ind.count_orders == 1 and ind.avg_longest_streak_days == dec("2.0")
    null_group = out[(None, "standard")]
    assert null_group.count_members == 1 and null_group.count_orders is None
    assert null_group.avg_longest_streak_days is None
