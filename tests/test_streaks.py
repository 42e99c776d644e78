

from pyspark.sql import functions as F

from helpers import d, exchanges, final_plan, plan_text, rows
from tallyframe.functions.exprs import threshold_flag
from tallyframe.operators import streaks as sk

SCHEMA = "member_id string, activity_date date, very int, moderate int"


def activity(spark):
    data = [
        # m1: one-day run, then a run over 28/29 Feb and 1 Mar 2024, a gap of one day, one more day
        ("m1", d("2024-02-20"), 20, 0),
        ("m1", d("2024-02-28"), 10, 5), ("m1", d("2024-02-29"), 15, 0), ("m1", d("2024-03-01"), 0, 15),
        ("m1", d("2024-03-03"), 30, 0),
        # m2: a run over a month end with a duplicated day and an inactive day inside
        ("m2", d("2024-01-30"), 15, 0), ("m2", d("2024-01-31"), 15, 0), ("m2", d("2024-01-31"), 15, 0),
        ("m2", d("2024-02-01"), 15, 0), ("m2", d("2024-02-02"), 1, 1), ("m2", d("2024-02-03"), 16, 0),
        # m3: null minutes only, never active
        ("m3", d("2024-03-03"), None, None), ("m3", d("2024-03-02"), None, 20),
        # m4: data ends before the table's newest day
        ("m4", d("2024-01-01"), 40, 0), ("m4", d("2024-01-02"), 40, 0),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    return df.withColumn("is_active_day", threshold_flag(["very", "moderate"], 15))


def test_streaks(spark):
    s = sk.member_streaks(activity(spark))
    got = rows(s, "member_id", "streak_start_date", "streak_end_date", "streak_length_days", "streak_recency_rank")
    assert got == sorted([
        ("m1", d("2024-02-20"), d("2024-02-20"), 1, 3),
        ("m1", d("2024-02-28"), d("2024-03-01"), 3, 2),
        ("m1", d("2024-03-03"), d("2024-03-03"), 1, 1),
        ("m2", d("2024-01-30"), d("2024-02-01"), 3, 2),
        ("m2", d("2024-02-03"), d("2024-02-03"), 1, 1),
        ("m4", d("2024-01-01"), d("2024-01-02"), 2, 1),
    ], key=lambda t: tuple((x is None, str(x)) for x in t))


def test_sum_of_lengths_is_active_member_days_and_runs_do_not_touch(spark):
    act = activity(spark)
    s = sk.member_streaks(act)
    active_days = sk.day_grain(act).filter("is_active_day").count()
    assert s.agg(F.sum("streak_length_days")).collect()[0][0] == active_days
    by_member = {}
    for r in s.collect():
        by_member.setdefault(r.member_id, []).append((r.streak_start_date, r.streak_end_date))
    for runs in by_member.values():
        runs.sort()
        for (_, e1), (s2, _) in zip(runs, runs[1:]):
            assert (s2 - e1).days >= 2


def test_latest_status_uses_global_as_of(spark):
    act = activity(spark)
    st = sk.latest_streak_status(sk.member_streaks(act), sk.as_of_date(act))
    got = {r.member_id: (r.streak_length_days, r.days_since_streak_end, r.is_current) for r in st.collect()}
    assert got == {"m1": (1, 0, 1), "m2": (1, 29, 0), "m4": (2, 61, 0)}
    summary = {r.member_id: tuple(r) for r in sk.streak_summary(sk.member_streaks(act), sk.as_of_date(act)).collect()}
    assert summary["m1"] == ("m1", 3, 1, 1) and summary["m4"] == ("m4", 2, 2, 0)


def test_longest(spark):
    got = {r.member_id: r.longest_streak for r in sk.longest_streak(sk.member_streaks(activity(spark))).collect()}
    assert got == {"m1": 3, "m2": 3, "m4": 2}


def test_one_exchange_after_day_grain(spark):
    days = sk.day_grain(activity(spark))
    base = exchanges(days)
    s = sk.member_streaks(days, already_daily=True)
    # the window / run aggregate / recency window chain shares one hash(member) exchange
    assert exchanges(s) == base + 1, final_plan(s)
    text = final_plan(s)
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA + ", is_active_day boolean")
    assert sk.member_streaks(empty).count() == 0


def test_window_input_has_no_unpartitioned_window(spark):
    s = sk.member_streaks(activity(spark))
    s.collect()
    assert "SinglePartition" not in plan_text(s)




def test_day_grain_is_combined_map_side(spark):
    s = sk.member_streaks(activity(spark))
    s.collect()
    text = final_plan(s)
    # partial aggregate below the first exchange: a hot member is reduced before the shuffle
    assert "partial_max(is_active_day" in text or "partial_bool_or" in text, text


def test_two_exchanges_from_raw_rows(spark):
    raw = activity(spark).repartition(4)
    base = exchanges(raw)
    s = sk.member_streaks(raw)
    # day grain (map-side combined) + the member window chain
    assert exchanges(s) == base + 2, final_plan(s)


def test_rows_without_a_date(spark):
    """They make one run without dates, which ranks first; the other runs are as without them."""
    rows_ = [("m", d("2024-01-01"), True), ("m", d("2024-01-02"), True), ("m", None, True), ("m", d("2024-01-05"), True), ("n", None, False), ("n", d("2024-01-01"), True)]
    df = spark.createDataFrame(rows_, "member_id string, activity_date date, is_active_day boolean")
    assert rows(sk.member_streaks(df)) == sorted([
        ("m", None, None, 1, 1), ("m", d("2024-01-05"), d("2024-01-05"), 1, 2), ("m", d("2024-01-01"), d("2024-01-02"), 2, 3),
        ("n", d("2024-01-01"), d("2024-01-01"), 1, 1)], key=lambda t: tuple((x is None, str(x)) for x in t))
