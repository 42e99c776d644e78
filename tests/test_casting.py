import pytest
from pyspark.errors import ArithmeticException, NumberFormatException, PySparkException
from pyspark.sql import functions as F

from helpers import d, dec
from tallyframe.functions.casting import ColumnCast as C
from tallyframe.functions.casting import apply_casts, int_from_text
from tallyframe.plans import staging as st


def test_accounts_blank_rate_is_null_and_text_kept(spark):
    raw = spark.createDataFrame(
        [("a1", "organization", "Acme, Inc.", "Retail", "active", "12.5"),
         ("a2", "individual", None, None, "active", ""),
         ("a3", "individual", "Zoë \"Z\" Ltd", "", "active", None)],
        "account_id string, account_type string, account_name string, industry string, status string, "
        "per_member_rate string")
    out = {r.account_id: r for r in st.stage_accounts(raw).collect()}
    assert out["a1"].per_member_rate == dec("12.50")
    assert out["a2"].per_member_rate is None
    assert out["a3"].per_member_rate is None
    assert out["a3"].account_name == 'Zoë "Z" Ltd'
    assert out["a1"].account_name == "Acme, Inc."


def test_integral_text_rating(spark):
    df = spark.createDataFrame([("4.0",), ("3",), ("",), (None,)], "r string")
    got = [r.r for r in df.select(int_from_text(F.nullif("r", F.lit(""))).alias("r")).collect()]
    assert got == [4, 3, None, None]


def test_fractional_rating_fails(spark):
    df = spark.createDataFrame([("4.5",)], "r string")
    with pytest.raises(PySparkException):
        df.select(int_from_text(F.col("r"))).collect()


def test_members_boolean_text(spark):
    raw = spark.createDataFrame([("m1", "a1", "x@y", "2024-02-29", "enrolled", "True", "False")],
                                "member_id string, account_id string, email string, join_date string, "
                                "eligibility_status string, sponsored string, is_fitbit_seed string")
    r = st.stage_members(raw).collect()[0]
    assert r.sponsored is True and r.is_fitbit_seed is False and r.join_date == d("2024-02-29")


def test_decimal_overflow_fails(spark):
    raw = spark.createDataFrame([("p1", "Std", "standard", "12345.67")],
                                "plan_id string, plan_name string, tier string, monthly_price string")
    with pytest.raises((ArithmeticException, PySparkException)):
        st.stage_plans(raw).collect()


def test_bad_date_fails(spark):
    raw = spark.createDataFrame([("o1", "m1", "coaching_session", "2024-13-01", "10.00", "completed")],
                                "order_id string, member_id string, order_type string, order_date string, "
                                "amount string, status string")
    with pytest.raises((NumberFormatException, PySparkException)):
        st.stage_orders(raw).collect()


def test_subscription_open_end(spark):
    raw = spark.createDataFrame([("s1", "m1", "p", "2024-01-31", "", "active", "14.99"),
                                 ("s2", "m1", "p", "2024-01-01", "2024-02-01", "ended", "9.5")],
                                "subscription_id string, member_id string, plan_id string, start_date string, "
                                "end_date string, status string, billed_amount string")
    out = {r.subscription_id: r for r in st.stage_subscriptions(raw).collect()}
    assert out["s1"].end_date is None and out["s2"].end_date == d("2024-02-01")
    assert out["s2"].billed_amount == dec("9.50")


def test_ticket_category_map_case_insensitive_and_unmatched_kept(spark):
    raw = spark.createDataFrame(
        [("t1", "m", "TECHNICAL ISSUE", "Closed", "High", "Email", " 5.0 ", "2024-01-01", "2024-01-02"),
         ("t2", "m", "Something else", "Open", "Low", "Chat", "", "2024-01-01", "")],
        "ticket_id string, member_id string, ticket_type string, ticket_status string, ticket_priority string, "
        "ticket_channel string, csat_rating string, created_at string, resolved_at string")
    out = {r.ticket_id: r for r in st.stage_tickets(raw).collect()}
    assert out["t1"].ticket_category == "App/device sync issue" and out["t1"].csat_rating == 5
    assert out["t2"].ticket_category == "Something else" and out["t2"].csat_rating is None
    assert out["t2"].resolved_at is None


def test_workouts_flag_false_on_null_and_rename(spark):
    cols = ("workout_id string, member_id string, activity_date string, steps string, distance_km string, "
            "very_active_minutes string, moderately_active_minutes string, light_active_minutes string, "
            "sedentary_minutes string, calories_burned string, source string")
    raw = spark.createDataFrame([("w1", "m", "2024-01-01", "10", "1.5", "10", "5", "0", "0", "0", "synthetic"),
                                 ("w2", "m", "2024-01-02", "10", "1.5", "10", None, "0", "0", "0", "real_fitbit"),
                                 ("w3", "m", "2024-01-03", "10", "1.5", "10", "4", "0", "0", "0", "synthetic")],
                                cols)
    out = {r.workout_id: r for r in st.stage_workouts(raw).collect()}
    assert out["w1"].is_active_day is True
    assert out["w2"].is_active_day is False
    assert out["w3"].is_active_day is False
    assert out["w2"].data_source == "real_fitbit"


def test_apply_casts_projection_order(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    out = apply_casts(df, [C("b"), C("a2", source="a", dtype="int")])
    assert out.columns == ["b", "a2"] and out.collect()[0].a2 == 1
